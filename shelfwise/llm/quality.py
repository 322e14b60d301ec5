"""Quality rules with thresholds from mergeable quantile sketches (operator 3).

Words are runs of ``[^\\x20\\x09-\\x0D]``. Each document gets counts (words, symbols, repeated lines,
words in repeated 8-word windows, capitals, exclamation marks), and from them six integer rates.

*Base rules* are fixed: ``n_words < 20`` or more than 30 % repeated words fails.

*Adaptive rules.* Per language and source, every rate has a sketch: counts of log-linear buckets
(exact below 128, then 64 buckets per power of two, so a quantile is within 1/64). Sketches merge by
adding counts, so tasks pre-aggregate them, a hot source costs a few rows per task, and the sketch of
a language or of everything is the sum of its groups'. A rate above ``q75 + 3 * max(q75 - q25,
floor)`` fails (for the word length also below ``q25 - 3 * ...``). The floor is the rate's resolution
and keeps a group without spread from rejecting ordinary documents. A group with fewer than
``least_rows`` documents takes its language's sketch, then the whole table's.

Cases: null or blank text has zero counts and fails the base rules; null language or source is a
group of its own; every row is judged and returned, also repeated ones and those without an id; extra
columns are kept or ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.blocks import SPACE, hand_off, lane_hashes, mix, text_bytes, unused, word_spans

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_caps", "n_marks"]
WINDOW = 8
CHUNK = 1 << 21

# Rate: numerator, denominator, floor of its spread (all times 10000), and whether low values fail too.
RATES = {
    "symbol_rate": ("n_symbols", "n_words", 1000, False),
    "mark_rate": ("n_marks", "n_words", 1000, False),
    "caps_rate": ("n_caps", "word_chars", 1000, False),
    "dup_line_rate": ("n_dup_lines", "n_lines", 2000, False),
    "repeat_rate": ("n_repeat_words", "n_words", 1000, False),
    "word_length": ("word_chars", "n_words", 10000, True),
}
LEAST_ROWS = 200
SPREADS = 3


def _members(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in chars]] = True
    return out


SYMBOLS, CAPS, MARKS = _members("#*$%&|<>"), _members("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _members("!?")


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _order_and_repeats(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by (row, key), and which sorted entries equal the one before."""
    order = np.lexsort((key, row))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (row[order][1:] == row[order][:-1]) & (key[order][1:] == key[order][:-1])
    return order, same


def count_rows(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All counts of some texts at once."""
    rows = len(offsets) - 1
    start, end, row = word_spans(data, offsets)
    lead = ~SPACE[data] & ((data & 0xC0) != 0x80)
    out = {"n_words": np.bincount(row, minlength=rows), "word_chars": _per_row(lead, offsets)}
    out |= {name: _per_row(flags[data], offsets) for name, flags in (("n_symbols", SYMBOLS), ("n_caps", CAPS), ("n_marks", MARKS))}

    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_row = np.searchsorted(offsets, line_start, side="right") - 1
    line_end = np.minimum(np.concatenate([line_start[1:], [len(data)]]), offsets[1:][line_row])
    closed = (line_end > line_start) & (data[line_end - 1] == 10) if len(data) else np.zeros(0, bool)
    line_end = line_end - closed
    worded = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end, line_row = line_start[worded], line_end[worded], line_row[worded]
    _, same = (order_same := _order_and_repeats(line_row, lane_hashes(data, line_start, line_end, 11)))
    out["n_lines"] = np.bincount(line_row, minlength=rows)
    out["n_dup_lines"] = np.bincount(line_row[order_same[0]][same], minlength=rows)

    words = lane_hashes(data, start, end, 12)
    size = max(0, len(words) - WINDOW + 1)
    rolled = np.zeros(size, dtype=np.uint64)
    for k in range(WINDOW):
        rolled = mix(rolled + words[k : k + size] * np.uint64(2 * k + 3), 13 + k)
    whole = row[:size] == row[WINDOW - 1 : WINDOW - 1 + size]
    at = np.flatnonzero(whole)
    order, same = _order_and_repeats(row[at], rolled[at])
    twice = same.copy()
    twice[:-1] |= same[1:]
    step = np.zeros(len(words) + 1, np.int64)
    hits = at[order[twice]]
    step[hits] += 1
    step[hits + WINDOW] -= 1
    out["n_repeat_words"] = np.bincount(row[np.cumsum(step)[:-1] > 0], minlength=rows)
    return out


def _count(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(text_at))
            row = 0
            while row < batch.num_rows:
                last = min(batch.num_rows, max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1))
                begin, end = offsets[row], offsets[last]
                counts = count_rows(data[begin:end], offsets[row : last + 1] - begin)
                yield pa.RecordBatch.from_arrays([*batch.slice(row, last - row).columns, *(pa.array(counts[c], pa.int64()) for c in COUNTS)], [*batch.schema.names, *COUNTS])
                row = last
    return run


def counted(documents: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) with the counts, ``base_failed`` and the rates (null at 0/0).

    Input columns named like a count or rate are replaced.
    """
    names = [c for c in (documents.columns if keep is None else keep) if c not in (*COUNTS, *RATES, "base_failed")]
    (text,) = unused([*names, *COUNTS], "_text")
    rows = documents.select(*names, F.col(text_col).alias(text))
    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in COUNTS)])
    out = rows.mapInArrow(_count(len(names)), schema).drop(text)
    out = out.withColumn("base_failed", F.expr(f"n_words < 20 or 100 * n_repeat_words > 30 * n_words"))
    return out.withColumns({name: F.expr(f"case when {den} > 0 then 10000 * {num} div {den} end") for name, (num, den, _, _) in RATES.items()})


# Log-linear buckets of a rate v: v below 128, then 64 buckets per power of two; the bucket's largest value.
BUCKET = "case when v < 128 then v else (length(bin(v)) - 7) * 64 + shiftright(v, length(bin(v)) - 7) end"
BUCKET_TOP = "case when b < 128 then b else shiftleft(b % 64 + 65, cast(b div 64 - 1 as int)) - 1 end"


def sketches(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by..., rate, b, c): bucket counts of every rate of every group."""
    rates = F.explode(F.array(*[F.struct(F.lit(name).alias("rate"), F.col(name).alias("v")) for name in RATES])).alias("r")
    return rows.select(*by, rates).select(*by, "r.rate", "r.v").where("v is not null").groupBy(*by, "rate", F.expr(BUCKET).cast("long").alias("b")).agg(F.count("*").alias("c"))


def quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(by..., rate, rows, q25, q75) of merged sketches; a group has a bounded number of buckets."""
    keys = ", ".join(f"`{c}`" for c in [*by, "rate"])
    ranked = sketch.withColumns({"rows": F.expr(f"sum(c) over (partition by {keys})"), "upto": F.expr(f"sum(c) over (partition by {keys} order by b)")})
    return ranked.groupBy(*by, "rate").agg(F.max("rows").alias("rows"), *[
        F.min(F.expr(f"case when 100 * upto >= {q} * rows then {BUCKET_TOP} end")).alias(f"q{q}") for q in (25, 75)])


def thresholds(sketch: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """(lang, source, limits): the limits of each rate for each group of the sketch (keys ``_lang, _source``)."""
    merge = lambda by: quantiles(sketch.groupBy(*by, "rate", "b").agg(F.sum("c").alias("c")), by)
    level = [merge(["_lang", "_source"]), merge(["_lang"]), merge([])]
    named = [q.select(*[c for c in q.columns if c.startswith("_")], F.col("rate"), *[F.col(c).alias(f"{c}_{k}") for c in ("rows", "q25", "q75")]) for k, q in enumerate(level)]
    wide = named[0].join(named[1], ["_lang", "rate"]).join(named[2], ["rate"])
    pick = lambda c: F.expr(f"case when rows_0 >= {least_rows} then {c}_0 when rows_1 >= {least_rows} then {c}_1 else {c}_2 end")
    floor = F.create_map(*[F.lit(x) for name, spec in RATES.items() for x in (name, spec[2])])[F.col("rate")]
    spread = F.greatest(pick("q75") - pick("q25"), floor)
    limits = wide.select("_lang", "_source", "rate", (pick("q25") - SPREADS * spread).alias("low"), (pick("q75") + SPREADS * spread).alias("high"))
    return limits.groupBy("_lang", "_source").agg(*[F.max(F.expr(f"case when rate = '{name}' then {end} end")).alias(f"{end}_{name}") for name in RATES for end in ("low", "high")])


def _keys(rows: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """Group keys without nulls: a null's key differs from every string's."""
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    return rows.withColumns({"_lang": key(lang_col), "_source": key(source_col)})


def judge(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """``rows`` (with counts, rates and keys) with ``kept``: the base rules and the group's limits."""
    fails = " or ".join(f"coalesce({name} > high_{name}{f' or {name} < low_{name}' if both else ''}, false)" for name, (_, _, _, both) in RATES.items())
    return rows.join(limits, ["_lang", "_source"], "left").withColumn("kept", F.expr(f"not base_failed and not ({fails})"))


def quality_rules(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_rows: int = LEAST_ROWS) -> DataFrame:
    """Per row: the id, counts, ``base_failed``, the rates, and the verdict ``kept``."""
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    rows = hand_off(_keys(counted(rows, "text", ["doc_id", "lang", "source"]), "lang", "source"), "counts")
    limits = hand_off(thresholds(hand_off(sketches(rows, ["_lang", "_source"]), "sketches"), least_rows), "limits")
    return judge(rows, limits).drop("_lang", "_source")


def keep_good(documents: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_rows: int = LEAST_ROWS) -> DataFrame:
    """The rows of ``documents`` that the rules keep, with their own columns."""
    spare = documents.select(F.struct(*documents.columns).alias("_row"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    narrow = _keys(counted(spare, "text", ["lang", "source"]), "lang", "source")
    limits = hand_off(thresholds(hand_off(sketches(narrow, ["_lang", "_source"]), "sketches"), least_rows), "limits")
    return judge(_keys(counted(spare, "text", ["_row", "lang", "source"]), "lang", "source"), limits).where("kept").select("_row.*")
