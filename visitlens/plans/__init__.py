"""End-to-end plans: the visit mart and the SKU mart."""
