"""Sums of doubles without any rounding before the last step.

A double is cut into three whole numbers ("limbs") at fixed powers of two: its *band* is the block of
26 binary places that its leading bit falls into, and its limbs count units of the band and of the two
bands below, so that ``x = (l0 * 2**52 + l1 * 2**26 + l2) * 2**(26 * (band - 2))`` holds exactly. Limbs of one band add up
as whole numbers in any order; NaN and the infinities are counted. So a sum is a small mergeable *state*
with one row per group and band (amounts of one kind rarely fill more than two or three bands):

    _band, _l0, _l1, _l2      the limbs (decimal once merged, so no count of rows overflows)
    _nan, _pos, _neg          how many NaN, +infinity, -infinity
    _count, _rows             values that are not null, and all rows

``accumulate`` builds the state from values, or merges states into coarser groups; ``totals`` reads the
double nearest to each group's true sum, which is what ``math.fsum`` gives, whatever the order, the
partitions or the merges before. All of it is built from Spark expressions; both steps combine on the map side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 26
BASE = 1 << WIDTH
LOWEST, HIGHEST = -42, 39  # bands of the least and the largest double
STATE = ["_band", "_l0", "_l1", "_l2", "_nan", "_pos", "_neg", "_count", "_rows"]
_LIMB = "decimal(38,0)"
_SHIFT = 8  # tiny values are scaled up by so many bands first, which is exact
_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def has_state(df: DataFrame) -> bool:
    return set(STATE) <= set(df.columns)


def _power(exponent: Column) -> Column:
    """2**exponent for a whole exponent in [-1022, 1023]: exact (a test goes through them all)."""
    return F.pow(F.lit(2.0), exponent)


def _limbs(df: DataFrame, value: str) -> DataFrame:
    """The state columns of single values."""
    x = F.col("_x")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    df = df.withColumn("_x", F.col(value).cast("double"))
    df = df.withColumn("_tiny", F.abs(x) < 2.0 ** -900).withColumn("_y", F.when(finite, F.when(F.col("_tiny"), x * 2.0 ** (WIDTH * _SHIFT)).otherwise(x)))
    # A hair below the logarithm: at the edge of a band the lower one is right too, the upper one would cut a bit off.
    band = F.when(F.col("_y") == 0, 0).otherwise(F.floor((F.log2(F.abs("_y")) - 0.001) / WIDTH)).cast("int")
    df = df.withColumn("_b", band)
    unit = lambda k: _power((F.col("_b") - k) * WIDTH)
    df = df.withColumn("_l0", (F.col("_y") / unit(0)).cast("bigint")).withColumn("_r", F.col("_y") - F.col("_l0") * unit(0))
    df = df.withColumn("_l1", (F.col("_r") / unit(1)).cast("bigint")).withColumn("_r", F.col("_r") - F.col("_l1") * unit(1))
    df = df.withColumn("_l2", (F.col("_r") / unit(2)).cast("bigint"))
    return df.withColumns({
        "_band": F.col("_b") - F.when(F.col("_tiny"), _SHIFT).otherwise(0),
        "_nan": F.coalesce(F.isnan(x), F.lit(False)).cast("bigint"),
        "_pos": F.coalesce(x == float("inf"), F.lit(False)).cast("bigint"),
        "_neg": F.coalesce(x == float("-inf"), F.lit(False)).cast("bigint"),
        "_count": x.isNotNull().cast("bigint"),
        "_rows": F.lit(1).cast("bigint"),
    }).drop("_x", "_y", "_b", "_r", "_tiny")


def accumulate(df: DataFrame, keys: Sequence[Column | str], value: str | None = None, extra: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """The state of ``value`` per key, one row per key and band.

    ``df`` holds values, or a state to merge (``value`` is then not read). ``extra`` adds mergeable columns:
    ``{name: ("sum" | "min" | "max", column)}``.
    """
    extra = dict(extra or {})
    merging = has_state(df)
    if not merging:
        df = _limbs(df, value)
    keyed = df.select(*[F.col(k) if isinstance(k, str) else k for k in keys], *STATE, *[F.col(c).alias(f"_in_{name}") for name, (_, c) in extra.items()])
    names = keyed.columns[: len(keys)]
    # Limbs of single values stay below 2**26, so 10**11 of them add up as bigint (beyond, Spark raises); merged ones are decimals.
    limb = lambda c: F.sum(F.col(c).cast(_LIMB) if merging else c).cast(_LIMB).alias(c)
    count = lambda c: F.sum(c).cast("bigint").alias(c)
    return keyed.groupBy(*names, "_band").agg(
        *[limb(c) for c in ("_l0", "_l1", "_l2")], *[count(c) for c in STATE[4:]],
        *[_MERGE[how](f"_in_{name}").alias(name) for name, (how, _) in extra.items()])


def _two_to(k: int) -> Column:
    return F.lit(2 ** k).cast(f"decimal({len(str(2 ** k))},0)")


def _few(l0: Column, l1: Column, l2: Column) -> Column:
    """Whether ``_units`` may be asked for the limbs."""
    return (F.abs(l0) < 2 ** 38) & (F.abs(l1) < 2 ** 62) & (F.abs(l2) < 2 ** 62)


def _units(l0: Column, l1: Column, l2: Column) -> Column:
    """Limbs of one band, as one whole number of its least units."""
    return (l0.cast("decimal(13,0)") * _two_to(52) + l1.cast("decimal(21,0)") * _two_to(26) + l2).cast(_LIMB)


def nearest(states: Column) -> Column:
    """The double nearest to the sum of an array of (_band, _l0, _l1, _l2), one of each band."""
    let = lambda value, body: F.transform(F.array(value), body)[0]
    zero = F.lit(0).cast(_LIMB)

    def digits(low: Column, high: Column) -> Column:
        """What stands at each place of 26 bits, not yet carried."""
        at = lambda p: F.aggregate(states, zero, lambda acc, s: (acc + F.when(s["_band"] == p, s["_l0"]).when(s["_band"] - 1 == p, s["_l1"])
                                                                 .when(s["_band"] - 2 == p, s["_l2"]).otherwise(zero)).cast(_LIMB))
        return F.transform(F.sequence(low, high), at)

    def carried(raw: Column) -> Column:
        """(carry out of the top, digits in [0, 2**26) from low to high)."""
        start = F.struct(zero.alias("carry"), F.array().cast("array<bigint>").alias("digits"))

        def step(acc: Column, d: Column) -> Column:
            whole = (acc["carry"] + d).cast(_LIMB)
            digit = F.pmod(whole, F.lit(BASE).cast(_LIMB)).cast("bigint")
            carry = ((whole - digit) / F.lit(BASE).cast("decimal(9,0)")).cast(_LIMB)
            return F.struct(carry.alias("carry"), F.concat(acc["digits"], F.array(digit)).alias("digits"))
        return F.aggregate(raw, start, step)

    def value(d: Column, low: Column, top: Column) -> Column:
        """Digits without a sign to a double: the four leading digits as one whole number, a last bit for all others, rounded once."""
        lead = F.aggregate(F.sequence(top, top - 3), zero, lambda acc, i: (
            (acc * F.lit(BASE).cast("decimal(9,0)")).cast(_LIMB) + F.when(i >= 0, F.get(d, i)).otherwise(0).cast(_LIMB)).cast(_LIMB))
        rest = F.exists(F.transform(d, lambda x, i: (x != 0) & (i < top - 3)), lambda b: b)
        whole = ((lead * F.lit(2).cast("decimal(1,0)")).cast(_LIMB) + rest.cast("int")).cast("double")
        scaled = lambda e: whole * _power(F.floor(e / 2)) * _power(e - F.floor(e / 2))
        return let((low + top - 3) * WIDTH - 1, scaled)

    def signed(low: Column, raw: Column) -> Column:
        minus = F.transform(raw, lambda x: (-x).cast(_LIMB))
        sides = lambda c: F.when(c["carry"] >= 0, F.struct(F.lit(1.0).alias("sign"), c["digits"].alias("d"))).otherwise(
            F.struct(F.lit(-1.0).alias("sign"), carried(minus)["digits"].alias("d")))
        top = lambda d: F.array_max(F.transform(d, lambda x, i: F.when(x != 0, i)))
        return let(let(carried(raw), sides), lambda n: let(top(n["d"]), lambda t: F.when(t.isNull(), 0.0).otherwise(n["sign"] * value(n["d"], low, t))))

    first, last = (pick(F.transform(states, lambda s: s["_band"])) for pick in (F.array_min, F.array_max))
    whole = F.when(F.size(states) == 0, 0.0).otherwise(let(first - 2, lambda lo: let(digits(lo, last + 4), lambda raw: signed(lo, raw))))
    # One band, or two beside each other, with few leading units: one whole number holds the sum.
    limbs = lambda s: (s["_l0"], s["_l1"], s["_l2"])
    part = lambda s: _units(*limbs(s))
    units = lambda lo: F.aggregate(states, zero, lambda acc, s: (acc + F.when(s["_band"] == lo, part(s)).otherwise((part(s).cast("decimal(30,0)") * _two_to(26)).cast(_LIMB))).cast(_LIMB))
    short = let(first, lambda lo: units(lo).cast("double") * _power((lo - 2) * WIDTH))
    small = (last - first <= 1) & (first > -30) & F.forall(states, lambda s: _few(*limbs(s)))
    return F.when(small, short).otherwise(whole)


def totals(df: DataFrame, keys: Sequence[Column | str], value: str | None = None, out: str = "total",
           extra: Mapping[str, tuple[str, str]] | None = None, many: bool = False) -> DataFrame:
    """Per key: the double nearest to the true sum as ``out``, ``_count``, ``_rows`` and the ``extra`` columns.

    ``many`` says that there are nearly as many keys (then column names) as rows: nothing would combine on the
    map side, so the rows are dealt by key once, for both steps.

    Null without values; NaN beside a NaN or infinities of both signs; else the infinity that occurs. Sums
    beyond the largest double become infinite.
    """
    extra = dict(extra or {})
    if many:
        df = df.select(*keys, *(STATE if has_state(df) else [value]), *[c for _, c in extra.values()]).repartition(*keys)
    state = accumulate(df, keys, value, extra)
    names = state.columns[: len(keys)]
    parts = F.array_compact(F.collect_list(F.when(F.col("_band").isNotNull(), F.struct("_band", "_l0", "_l1", "_l2"))))
    only = [F.max(c).alias(f"_only{c}") for c in STATE[1:4]]  # the limbs, where a key has one band
    one = state.groupBy(*names).agg(
        parts.alias("_states"), F.min("_band").alias("_lowest"), F.max("_band").alias("_highest"), *only, *[F.sum(c).cast("bigint").alias(c) for c in STATE[4:]], *[_MERGE[how](name).alias(name) for name, (how, _) in extra.items()])
    only = [F.col(f"_only{c}") for c in STATE[1:4]]
    nan, pos, neg = (F.col(c) > 0 for c in ("_nan", "_pos", "_neg"))
    total = (F.when(F.col("_count") == 0, F.lit(None).cast("double")).when(nan | (pos & neg), float("nan")).when(pos, float("inf")).when(neg, float("-inf"))
             .when((F.col("_lowest") == F.col("_highest")) & (F.col("_lowest") > -30) & _few(*only), _units(*only).cast("double") * _power((F.col("_lowest") - 2) * WIDTH))
             .otherwise(nearest(F.col("_states"))))
    return one.select(*names, total.alias(out), "_count", "_rows", *extra)
