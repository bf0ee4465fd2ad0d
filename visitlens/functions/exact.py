"""Exact, order-independent sums of doubles, rounded once at the end.

A sum of doubles depends on the order of its terms, so on the partitioning, and a
rounded one can differ by a whole cent. Here every double is written as digits of
``WIDTH`` bits of its own binary value (none of its bits is changed), digits are
summed as integers, and only the total is rounded. All of it is native expressions
over columns.

A sum is a struct of ``LIMBS`` digit sums, the digit ``i`` counting units of
2^((``TOP`` - i) * ``WIDTH``), and ``rest``: a double sum of what the digits cannot
hold, that is NaN, infinities, magnitudes of 2^72 and more, and bits below 2^-120.
So for magnitudes between 2^-67 (7e-21) and 2^72 (5e21) ``rest`` is 0 and the sum is
exact. A digit sum has room for 2^39 doubles of a group, or sums that were carried
before; beyond that Spark's own overflow check ends the query rather than give a
wrong sum.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH, LIMBS, TOP = 24, 8, 2
_UNITS = [(TOP - i) * WIDTH for i in range(LIMBS)]
_NAMES = [f"d{i}" for i in range(LIMBS)]
_BASE = 1 << WIDTH

# The expressions are put together as SQL text, as each consists of a few hundred
# nodes: one call into the JVM for each, and each is made once in a process.


def _real(x: float) -> str:
    """A power of two as a double literal that says exactly that."""
    return f"{x!r}D"


_LIMIT = _real(2.0 ** (_UNITS[0] + WIDTH))


def _struct(digits: list[str], rest: str) -> str:
    fields = ", ".join(f"'{n}', {d}" for n, d in zip(_NAMES, digits))
    return f"named_struct({fields}, 'rest', {rest})"


def _fields(total: str) -> list[str]:
    return [f"{total}.{n}" for n in _NAMES]


@lru_cache(maxsize=None)
def held(x: str) -> Column:
    """What digits can hold of a double (SQL text): it, 0 in its place, or NULL."""
    return F.expr(f"IF(abs({x}) < {_LIMIT}, {x}, IF({x} IS NULL, NULL, 0D))")


def _parts(x: str, held: str) -> tuple[list[str], str]:
    # x in whole units of each place, rounded: differences are exact, digits up to 2^23
    whole = [f"rint({held} * {_real(2.0 ** -u)})" for u in _UNITS]
    digits = whole[:1] + [f"{whole[i]} - {whole[i - 1]} * {_real(float(_BASE))}" for i in range(1, LIMBS)]
    rest = f"{x} - IF({x} = {held}, {whole[-1]} * {_real(2.0 ** _UNITS[-1])}, 0D)"
    return [f"CAST({d} AS BIGINT)" for d in digits], rest


@lru_cache(maxsize=None)
def exact(x: str, held: str) -> Column:
    """A double column as a struct of digits. The column ``held`` is :func:`held` of it,
    made in a step before."""
    return F.expr(_struct(*_parts(x, held)))


@lru_cache(maxsize=None)
def exact_sum(x: str, held: str) -> Column:
    """Aggregate: the exact sum of a double column, as a struct of NULLs where all are NULL."""
    digits, rest = _parts(x, held)
    return F.expr(_struct([f"sum({d})" for d in digits], f"sum({rest})"))


@lru_cache(maxsize=None)
def merged_sum(total: str) -> Column:
    """Aggregate: the sum of a column of exact sums."""
    return F.expr(_struct([f"sum({d})" for d in _fields(total)], f"sum({total}.rest)"))


def _carried(digits: list[str], half: int) -> list[str]:
    """The same number with digits from -``half`` to 2^WIDTH - ``half`` - 1, but the first."""
    out, carry = [], None
    for d in reversed(digits):
        value = d if carry is None else f"({d} + {carry})"
        carry = f"shiftright({value} + {half}L, {WIDTH})"
        out.append((value, carry))
    first = out.pop()[0]
    return [first] + [f"({value} - {carry} * {_BASE}L)" for value, carry in reversed(out)]


@lru_cache(maxsize=None)
def times(total: str, n: str) -> Column:
    """``total`` times a whole number: as many sums of their own for the digits' room."""
    return F.expr(_struct([f"{d} * {n}" for d in _fields(total)], f"{total}.rest * {n}"))


@lru_cache(maxsize=None)
def carried(total: str) -> Column:
    """``total`` with small digits again, so that more sums can follow."""
    return F.expr(_struct(_carried(_fields(total), _BASE // 2), f"{total}.rest"))


@lru_cache(maxsize=None)
def rounded(total: str, places: int) -> Column:
    """A carried sum as a double, rounded half away from zero to ``places`` decimals.

    The decision is made on all digits. A sum that has a ``rest`` which counts (NaN,
    infinite or of at least 2^-60) is an ordinary double sum and rounded as such.
    """
    scaled = _carried([f"({d} * {10 ** places}L)" for d in _fields(total)], 0)
    whole = f"CAST({scaled[0]} AS DECIMAL(20,0))"
    for d in scaled[1:TOP + 1]:
        whole = f"(CAST({whole} * {_BASE}BD AS DECIMAL(38,0)) + CAST({d} AS DECIMAL(10,0)))"
    first, *low = scaled[TOP + 1:]
    half = _BASE // 2
    up = f"({first} > {half} OR ({first} = {half} AND ({scaled[0]} >= 0 OR ({' | '.join(low)}) <> 0)))"
    exact = f"CAST({whole} + IF({up}, 1BD, 0BD) AS DOUBLE) / {float(10 ** places)!r}D"
    plain = " + ".join(f"{d} * {_real(2.0 ** u)}" for d, u in reversed([*zip(_fields(total), _UNITS)]))
    counts = f"isnan({total}.rest) OR abs({total}.rest) >= {_real(2.0 ** -60)}"
    return F.expr(f"IF({total}.d0 IS NULL, NULL, IF({counts}, round({plain} + {total}.rest, {places}), {exact}))")
