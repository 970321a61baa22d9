"""Rules proposed from the data beyond a column's bounds (F11): composite keys (A2), lookups (P10), patterns.

Each finds candidates from mergeable sketches or heavy hitters, one aggregate for all of them, and verifies what
is left exactly; only verified proposals are returned. What reaches the driver is a row per column, combination
of columns, pair of columns or mask, never per row of data.
"""

from __future__ import annotations

import json
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.local import local_frame
from tessera.functions.predicates import regex_mismatch
from tessera.operators.profile import INTEGRAL, SKETCH_BITS, SKETCH_GROUPS, _key

# A sketch of 2^12 hashes is off by 1.6 %: what misses by more than three times that is no candidate.
MARGIN = 0.05
# Repeats are looked for in one part in so many of the space of digests, then in all of it: one repeat is proof against a key.
SHARES = (64, 8, 1)
KEY_TYPES = (*INTEGRAL, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


# ---- composite keys (A2) ------------------------------------------------------------------

def _sketched(df: DataFrame, hashes: list) -> list[int]:
    """Estimated distinct values of each hash, all from one aggregate in two levels."""
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_g")
    rows = df.select(group, *[h.alias(f"k{i}") for i, h in enumerate(hashes)])
    parts = rows.groupBy("_g").agg(*[F.theta_sketch_agg(f"k{i}", F.lit(SKETCH_BITS)).alias(f"k{i}") for i in range(len(hashes))])
    row = parts.agg(*[F.theta_sketch_estimate(F.theta_union_agg(f"k{i}", F.lit(SKETCH_BITS))).alias(f"k{i}") for i in range(len(hashes))])
    return [int(v or 0) for v in row.first()]


def _repeated(df: DataFrame, digests: list, share: int) -> set[int]:
    """The numbers of the digests that two rows have in common, told from one part in ``share`` of the digests' space."""
    entries = [F.struct(F.lit(i).alias("combo"), a.alias("a"), b.alias("b")) for i, (a, b) in enumerate(digests)]
    if share > 1:
        entries = [F.when(F.pmod(a, F.lit(share)) == 0, e) for e, (a, _) in zip(entries, digests)]
    rows = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    twice = rows.groupBy("combo", "a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return {r["combo"] for r in twice.select("combo").distinct().collect()}


def composite_keys(df: DataFrame, max_size: int = 3, columns: list[str] | None = None) -> list[tuple[str, ...]]:
    """The minimal combinations of at most ``max_size`` columns without NULLs that tell all rows apart.

    Level by level: combinations that hold a found key are left out, so are those whose columns' distinct counts
    multiply to less than the rows; the others' distinct counts are sketched together. Of those that may reach the
    number of rows, a repeat in a small share of the digests' space rules out most; what is left is checked in all of it.
    """
    fields = {f.name: f for f in df.schema.fields if isinstance(f.dataType, KEY_TYPES)}
    names = [c for c in (columns or df.columns) if c in fields]
    counts = df.agg(F.count(F.lit(1)), *[F.count(F.col(f"`{c}`")) for c in names]).first()
    rows, names = counts[0], [c for c, n in zip(names, counts[1:]) if n == counts[0]]
    if not rows or not names:
        return []
    hashed = lambda combo, salt: F.xxhash64(F.lit(salt), *[part for c in combo for part in _key(fields[c])])
    least = rows * (1 - MARGIN)
    distinct: dict[str, int] = {}
    found: list[tuple[str, ...]] = []
    for size in range(1, max_size + 1):
        level = [c for c in combinations(names, size) if not any(set(k) <= set(c) for k in found)]
        if size > 1:
            def reach(combo):
                out = 1
                for c in combo:
                    out *= distinct[c] * (1 + MARGIN)
                return out >= least
            level = [c for c in level if reach(c)]
        if not level:
            continue
        estimates = _sketched(df, [hashed(c, "a") for c in level])
        if size == 1:
            distinct = {c[0]: n for c, n in zip(level, estimates)}
        likely = [c for c, n in zip(level, estimates) if n >= least]
        if not likely:
            continue
        digests = {c: (hashed(c, "a"), hashed(c, "b")) for c in likely}
        for share in SHARES:
            if len(digests) > (share > 1):  # a single one is checked at once
                repeated = _repeated(df, list(digests.values()), share)
                digests = {c: d for i, (c, d) in enumerate(digests.items()) if i not in repeated}
        found += digests
    return found


# ---- lookups (P10): inclusion dependencies ---------------------------------------------------

def _family(dtype: T.DataType) -> str | None:
    return "whole" if isinstance(dtype, INTEGRAL) else "text" if isinstance(dtype, T.StringType) else None


def column_sketches(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, family, rows, n, sketch, low, high) per whole-number and text column: one aggregate a
    table. ``low`` and ``high`` are of whole numbers."""
    out = None
    for name, df in tables.items():
        fields = [f for f in df.schema.fields if _family(f.dataType)]
        if not fields:
            continue
        group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_g")
        whole = [isinstance(f.dataType, INTEGRAL) for f in fields]
        rows = df.select(group, *[F.when(F.col(f"`{f.name}`").isNotNull(), F.xxhash64(*_key(f))).alias(f"k{i}") for i, f in enumerate(fields)],
                         *[F.col(f"`{f.name}`").cast("long").alias(f"v{i}") for i, f in enumerate(fields) if whole[i]])
        aggs = [F.count(F.lit(1)).alias("rows")]
        ends = [F.sum("rows").alias("rows")]
        for i, _ in enumerate(fields):
            aggs += [F.theta_sketch_agg(f"k{i}", F.lit(SKETCH_BITS)).alias(f"s{i}")]
            ends += [F.theta_union_agg(f"s{i}", F.lit(SKETCH_BITS)).alias(f"s{i}")]
            if whole[i]:
                aggs += [F.min(f"v{i}").alias(f"l{i}"), F.max(f"v{i}").alias(f"h{i}")]
                ends += [F.min(f"l{i}").alias(f"l{i}"), F.max(f"h{i}").alias(f"h{i}")]
        none = F.lit(None).cast("long")
        entries = [F.struct(F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"), F.lit(_family(f.dataType)).alias("family"),
                            F.col("rows").alias("rows"), F.theta_sketch_estimate(f"s{i}").alias("n"), F.col(f"s{i}").alias("sketch"),
                            (F.col(f"l{i}") if whole[i] else none).alias("low"), (F.col(f"h{i}") if whole[i] else none).alias("high"))
                   for i, f in enumerate(fields)]
        one = rows.groupBy("_g").agg(*aggs).agg(*ends).select(F.explode(F.array(*entries)).alias("e")).select("e.*")
        out = one if out is None else out.unionByName(one)
    return out


def lookup_rules(spark: SparkSession, tables: dict[str, DataFrame], least_values: int = 2) -> DataFrame:
    """(table_name, column_name, lookup_table, lookup_column, coverage): columns all of whose values are among the
    values of another table's key column. ``coverage`` is the share of the lookup's values in use (sketched).

    Pairs are pruned by distinct counts, by bounds of whole numbers and by the sketched share of values contained;
    the survivors' lookups are then checked to be keys and their values joined, exactly.
    """
    schema = "table_name string, column_name string, lookup_table string, lookup_column string, coverage double"
    sketches = column_sketches(spark, tables)
    if sketches is None:
        return local_frame(spark, [], schema)
    sketches = local_frame(spark, sketches.collect(), sketches.schema)  # a row per column
    a, b = sketches.alias("a"), sketches.alias("b")
    near_key = F.col("b.n") >= F.col("b.rows") * (1 - MARGIN)
    pairs = (a.join(b, (F.col("a.family") == F.col("b.family")) & (F.col("a.table_name") != F.col("b.table_name")) & near_key
                    & (F.col("a.n") >= least_values) & (F.col("a.n") <= F.col("b.n") * (1 + MARGIN))
                    & F.coalesce((F.col("a.low") >= F.col("b.low")) & (F.col("a.high") <= F.col("b.high")), F.lit(True)))
             .select(F.col("a.table_name").alias("t"), F.col("a.column_name").alias("c"), F.col("b.table_name").alias("u"),
                     F.col("b.column_name").alias("d"), F.col("a.n").alias("n"), F.col("b.n").alias("m"),
                     F.theta_sketch_estimate(F.theta_intersection("a.sketch", "b.sketch")).alias("both")))
    # The intersection of sketches of unlike size is off by more than one sketch is.
    likely = [r for r in pairs.collect() if r["both"] >= r["n"] * (1 - 4 * MARGIN) - 1 or r["n"] < 50]
    out = []
    lookups = sorted({(r["u"], r["d"]) for r in likely})
    unique = {}
    for u, d in lookups:
        column = F.col(f"`{d}`")
        twice = tables[u].where(column.isNotNull()).groupBy(column.alias("k")).count().where("count > 1")
        unique[u, d] = not twice.take(1) and not tables[u].where(column.isNull()).take(1)
    for r in likely:
        if not unique[r["u"], r["d"]]:
            continue
        mine = tables[r["t"]].select(F.col(f"`{r['c']}`").alias("k")).dropna().distinct()
        theirs = tables[r["u"]].select(F.col(f"`{r['d']}`").alias("k"))
        if not mine.join(theirs, "k", "left_anti").take(1):
            out.append((r["t"], r["c"], r["u"], r["d"], r["n"] / r["m"]))
    return local_frame(spark, sorted(out), schema)


def lookup_rule_logic(rules: DataFrame, dataset: str) -> list[tuple[str, str, str]]:
    """(table, column, rule logic) of proposed lookups, in the rule vocabulary."""
    return [(r["table_name"], r["column_name"], json.dumps({"allowed": {"dataset_id": dataset, "table_name": r["lookup_table"],
                                                                        "column_name": r["lookup_column"]}}))
            for r in rules.collect()]


# ---- patterns (P2) ---------------------------------------------------------------------------

PATTERN_LENGTH = 64      # longer texts follow no pattern
MAX_MASKS = 4            # alternatives of a pattern
RUNS = r"[0-9]+|[A-Z]+|[a-z]+|[^\x00-\x7F]+|[\x00-\x7F]"


def _mask(column):
    """Runs of digits, capitals, small letters and other alphabets as one sign each; other characters as they are."""
    out = F.regexp_replace(column, F.lit("[0-9]+"), F.lit("9"))
    for runs, sign in (("[A-Z]+", "A"), ("[a-z]+", "a"), (r"[^\x00-\x7F]+", "é")):
        out = F.regexp_replace(out, F.lit(runs), F.lit(sign))
    return out


def patterns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, regex) for text columns whose values follow at most ``MAX_MASKS`` masks.

    Heavy hitters among the masks are tracked in one aggregate; where they cover all values, the lengths of each mask's
    runs are bounded in a second, and a third counts the values that miss the regex: it must be none.
    """
    spark = df.sparkSession
    schema = "column_name string, regex string"
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)]
    if not names:
        return local_frame(spark, [], schema)
    short = lambda c: F.length(F.col(f"`{c}`")) <= PATTERN_LENGTH
    aggs = []
    for i, c in enumerate(names):
        mask = F.when(short(c), _mask(F.col(f"`{c}`")))
        aggs += [F.count(F.col(f"`{c}`")).alias(f"n{i}"), F.call_function("approx_top_k", mask, F.lit(MAX_MASKS + 1), F.lit(64)).alias(f"m{i}")]
    row = df.agg(*aggs).first()
    chosen = {}
    for i, c in enumerate(names):
        masks = {x["item"]: x["count"] for x in row[f"m{i}"] if x["item"] is not None}
        if row[f"n{i}"] and 0 < len(masks) <= MAX_MASKS and sum(masks.values()) == row[f"n{i}"]:
            chosen[c] = sorted(masks)
    if not chosen:
        return local_frame(spark, [], schema)
    entries = [F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value"))) for c in chosen]
    runs = (df.select(F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL").select("e.*")
            .select("column_name", _mask(F.col("value")).alias("mask"), F.posexplode(F.regexp_extract_all("value", F.lit(f"({RUNS})"))).alias("at", "run"))
            .groupBy("column_name", "mask", "at").agg(F.min(F.length("run")).alias("least"), F.max(F.length("run")).alias("most")).collect())
    regexes = {c: _regex(c, masks, {(r["column_name"], r["mask"], r["at"]): (r["least"], r["most"]) for r in runs}) for c, masks in chosen.items()}
    missed = df.agg(*[F.count_if(F.expr(regex_mismatch(c, regex))) for c, regex in regexes.items()]).first()
    return local_frame(spark, [(c, regex) for (c, regex), n in zip(regexes.items(), missed) if n == 0], schema)


def _regex(column: str, masks: list[str], lengths: dict) -> str:
    classes = {"9": "[0-9]", "A": "[A-Z]", "a": "[a-z]", "é": r"[^\x00-\x7F]"}

    def piece(mask: str, at: int, sign: str) -> str:
        if sign not in classes:
            return sign if sign.isalnum() or sign == " " else "\\" + sign
        least, most = lengths[column, mask, at]
        return classes[sign] + ("" if least == most == 1 else f"{{{least}}}" if least == most else f"{{{least},{most}}}")

    made = ["".join(piece(mask, at, sign) for at, sign in enumerate(mask)) for mask in masks]
    return f"^{made[0]}$" if len(made) == 1 else f"^({'|'.join(made)})$"
