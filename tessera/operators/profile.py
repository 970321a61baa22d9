"""Distributed column profile (F1-F10) and deterministic rule proposals.

One wide aggregate computes, for every column at once, null counts, numeric
min/max, string lengths and the e-mail / date flags. Sample values are the N least
distinct values, kept as a partial aggregate of N values a task and column (``least``).

Distinct counts are exact, by one shuffle of distinct fixed-width keys (numbers and times as they are, text as a
128-bit digest), or sketched (``approx``): theta sketches (k least hashes) that are exact up to ``2^SKETCH_BITS``
values and shuffle no values. Sketches, samples and the other figures are a mergeable state: ``profile_state`` of
each window or file can be kept, ``merge_states`` adds them up and ``profile_of`` shows the profile of all, the
same as one pass over all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.local import local_frame
from tessera.functions.predicates import NUMERIC, TEMPORAL
from tessera.operators.least import SLOT_TYPES, least_values

# E-mail shape, sample text cut-off and its ellipsis.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
SAMPLE_TEXT_LIMIT = 80
ELLIPSIS = "…"

KEY_TEXT = 200  # characters of a text that samples and proposals can show

# Text formats tried when deciding whether a string column holds dates.
DATE_FORMATS = ["yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy", "dd-MM-yyyy",
                "yyyy-MM-dd'T'HH:mm:ss", "yyyyMMdd", "yyyy-MM", "MMM d yyyy", "MMM d, yyyy", "d MMM yyyy", "dd.MM.yyyy"]

PROFILE_SCHEMA = ("column_name string, ordinal int, dtype string, row_count long, null_count long, "
                  "null_fraction double, distinct_count long, min_value double, max_value double, "
                  "min_length int, max_length int, looks_like_email boolean, looks_like_date boolean")


def _parses_as_date(c):
    """Judged by parsing. What no format can read - text without four digits, or far too short
    or long - is told without trying, since a failed parse is costly."""
    tried = [F.try_to_timestamp(c, F.lit(fmt)) for fmt in DATE_FORMATS] + [F.try_to_timestamp(c)]
    possible = F.length(c).between(6, 40) & c.rlike(r"\d\D*\d\D*\d\D*\d")
    return F.when(possible, F.coalesce(*tried).isNotNull()).otherwise(F.lit(False))


def _raw_stats(df: DataFrame) -> DataFrame:
    """F1-F3, F6-F9 in one aggregate, unpivoted to one row per column; flags are NULL where no value is."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    entries = []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count_if(c.isNull()).alias(f"n{i}"))
        numeric = isinstance(f.dataType, NUMERIC)
        text = isinstance(f.dataType, T.StringType)
        if numeric:
            aggs += [F.min(c.cast("double")).alias(f"lo{i}"), F.max(c.cast("double")).alias(f"hi{i}")]
        if text:
            aggs += [F.min(F.length(c)).alias(f"ll{i}"), F.max(F.length(c)).alias(f"lh{i}"),
                     F.bool_and(F.when(c.isNotNull(), c.rlike(EMAIL_PATTERN))).alias(f"em{i}"),
                     F.bool_and(F.when(c.isNotNull(), _parses_as_date(c))).alias(f"dt{i}")]
        null = F.lit(None)
        entries.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(i).cast("int").alias("ordinal"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"n{i}").cast("long").alias("null_count"),
            (F.col(f"lo{i}") if numeric else null.cast("double")).alias("min_value"),
            (F.col(f"hi{i}") if numeric else null.cast("double")).alias("max_value"),
            (F.col(f"ll{i}") if text else null.cast("int")).cast("int").alias("min_length"),
            (F.col(f"lh{i}") if text else null.cast("int")).cast("int").alias("max_length"),
            (F.col(f"em{i}") if text else null.cast("boolean")).alias("looks_like_email"),
            (F.col(f"dt{i}") if text else null.cast("boolean")).alias("looks_like_date"),
        ))
    row = df.agg(*aggs)
    return (row.select(F.col("_rows").cast("long").alias("row_count"), F.explode(F.array(*entries)).alias("e"))
            .select("e.*", "row_count"))


TEMPORAL_TYPES = ["date", "timestamp", "timestamp_ntz"]


def _shown_stats(raw: DataFrame) -> DataFrame:
    text = F.col("dtype") == "string"
    shown = lambda flag: F.when(text, F.coalesce(flag, F.lit(False)))
    fraction = F.when(F.col("row_count") > 0, F.col("null_count") / F.col("row_count")).otherwise(F.lit(0.0))
    return raw.withColumns({
        "looks_like_email": shown(F.col("looks_like_email")),
        "looks_like_date": F.when(F.col("dtype").isin(TEMPORAL_TYPES), F.lit(True)).otherwise(shown(F.col("looks_like_date"))),
        "null_fraction": fraction.cast("double")})


def column_stats(df: DataFrame) -> DataFrame:
    """One row per column."""
    return _shown_stats(_raw_stats(df))


INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _slots(f: T.StructField) -> dict[str, Column]:
    """The typed slots that hold one column's value, by which samples are ordered and shown.

    Integers, booleans, dates and timestamps go to ``i`` (days / microseconds), floating
    values to ``d``, decimals to ``d`` and ``s``; text puts its first characters in ``s`` and
    its digest in ``h`` and ``g``. Nothing is formatted as text until a sample is shown.
    """
    c = F.col(f"`{f.name}`")
    t = f.dataType
    if isinstance(t, (*INTEGRAL, T.BooleanType)):
        return {"i": c.cast("long")}
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return {"d": c.cast("double")}
    if isinstance(t, T.DateType):
        return {"i": F.unix_date(c).cast("long")}
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return {"i": F.unix_micros(c.cast("timestamp"))}
    if isinstance(t, T.DecimalType):
        return {"d": c.cast("double"), "s": c.cast("string")}
    text = c.cast("string")
    return {"s": F.substring(text, 1, KEY_TEXT), "h": F.xxhash64(F.lit("h"), text), "g": F.xxhash64(F.lit("g"), text)}


def _key(f: T.StructField) -> tuple[Column, Column]:
    """A value as two longs: whole numbers and times as they are, everything else by a 128-bit digest."""
    slots = _slots(f)
    if "i" in slots:
        return slots["i"], F.lit(0).cast("long")
    if "h" in slots:
        return slots["h"], slots["g"]
    value = slots.get("s", slots["d"] + 0.0)  # -0.0 and 0.0 are one value
    return F.xxhash64(F.lit("h"), value), F.xxhash64(F.lit("g"), value)


def _render(df: DataFrame) -> Column:
    """Text of a sample value from its typed slots, by the column's type."""
    out = F.lit(None).cast("string")
    for i, f in enumerate(df.schema.fields):
        t = f.dataType
        if isinstance(t, INTEGRAL):
            text = F.col("i").cast("string")
        elif isinstance(t, T.BooleanType):
            text = (F.col("i") == 1).cast("string")
        elif isinstance(t, (T.FloatType, T.DoubleType)):
            text = F.col("d").cast(t).cast("string")
        elif isinstance(t, T.DateType):
            text = F.date_from_unix_date(F.col("i").cast("int")).cast("string")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            text = F.timestamp_micros(F.col("i")).cast(t).cast("string")
        else:
            text = F.col("s")
        out = F.when(F.col("ordinal") == i, text).otherwise(out)
    return out


def distinct_keys(df: DataFrame) -> DataFrame:
    """(ordinal, key) of the distinct values of each column, pre-aggregated map-side on three numbers."""
    items = []
    for n, f in enumerate(df.schema.fields):
        a, b = _key(f)
        items.append(F.when(F.col(f"`{f.name}`").isNotNull(), F.struct(F.lit(n).cast("int").alias("ordinal"), a.alias("a"), b.alias("b"))))
    return (df.select(F.explode(F.array(*items)).alias("u")).where(F.col("u").isNotNull())
            .select("u.ordinal", "u.a", "u.b").distinct())


SKETCH_BITS = 12          # sketches hold 2^12 hashes: exact up to that many values, 1.6 % beyond
SKETCH_GROUPS = 1000      # partial sketches are first added up in so many groups


def distinct_sketches(df: DataFrame) -> DataFrame:
    """F4, sketched: (ordinal, sketch) per column. Tasks hand on one sketch a column; two levels, so
    that no task adds up the sketches of all others."""
    fields = df.schema.fields
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_g")
    hashed = df.select(group, *[F.when(F.col(f"`{f.name}`").isNotNull(), F.xxhash64(*_key(f))).alias(f"k{i}") for i, f in enumerate(fields)])
    parts = hashed.groupBy("_g").agg(*[F.theta_sketch_agg(f"k{i}", F.lit(SKETCH_BITS)).alias(f"k{i}") for i in range(len(fields))])
    row = parts.agg(*[F.theta_union_agg(f"k{i}", F.lit(SKETCH_BITS)).alias(f"k{i}") for i in range(len(fields))])
    entries = [F.struct(F.lit(i).cast("int").alias("ordinal"), F.col(f"k{i}").alias("sketch")) for i in range(len(fields))]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _estimate(sketch: Column) -> Column:
    return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("long")


def distinct_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    if approx:
        return distinct_sketches(df).select("ordinal", _estimate(F.col("sketch")).alias("distinct_count"))
    return distinct_keys(df).groupBy("ordinal").agg(F.count(F.lit(1)).cast("long").alias("distinct_count"))


def truncate_text(c):
    return F.when(F.length(c) > SAMPLE_TEXT_LIMIT,
                  F.concat(F.substring(c, 1, SAMPLE_TEXT_LIMIT), F.lit(ELLIPSIS))).otherwise(c)


SLOTS = list(SLOT_TYPES)


def _least(df: DataFrame, n: int) -> DataFrame:
    """(ordinal, rank, slots): the ``n`` least distinct values of each column."""
    values = least_values(df, [(i, _slots(f)) for i, f in enumerate(df.schema.fields)], n)
    w = Window.partitionBy("ordinal").orderBy(*SLOTS)
    return values.withColumn("sample_rank", F.row_number().over(w).cast("int")).where(F.col("sample_rank") <= n)


def sample_values(df: DataFrame, max_sample_values: int = 5, cut: bool = True) -> DataFrame:
    """first N distinct values per column in value order (numbers by number)."""
    text = truncate_text(_render(df)) if cut else _render(df)
    return _least(df, max_sample_values).select("ordinal", "sample_rank", text.alias("sample_value"))


PROFILE_COLUMNS = ["column_name", "ordinal", "dtype", "row_count", "null_count", "null_fraction", "distinct_count", "min_value",
                   "max_value", "min_length", "max_length", "looks_like_email", "looks_like_date", "sample_values"]


def _listed(samples: DataFrame) -> DataFrame:
    return (samples.groupBy("ordinal").agg(F.array_sort(F.collect_list(F.struct("sample_rank", "sample_value"))).alias("_s"))
            .select("ordinal", F.col("_s.sample_value").alias("sample_values")))


def _complete(stats: DataFrame) -> DataFrame:
    return stats.select(*[F.coalesce("distinct_count", F.lit(0)).cast("long").alias(c) if c == "distinct_count"
                          else F.coalesce(c, F.array().cast("array<string>")).alias(c) if c == "sample_values" else c
                          for c in PROFILE_COLUMNS])


def profile(df: DataFrame, max_sample_values: int = 5, approx: bool = False, cut: bool = True) -> DataFrame:
    """One row per column: F1-F9 plus ``sample_values`` as an ordered array, cut to their shown length.

    ``approx`` sketches the distinct counts; no values are shuffled then but the samples.
    """
    if approx:
        return profile_of(profile_state(df, max_sample_values), df, cut)
    samples = _listed(sample_values(df, max_sample_values, cut))
    return _complete(column_stats(df).join(distinct_counts(df), "ordinal", "left").join(samples, "ordinal", "left"))


# ---- mergeable profiles ------------------------------------------------------------

def profile_state(df: DataFrame, max_sample_values: int = 5) -> DataFrame:
    """What profiles of parts (windows, files) need to be added up: one row per column, of bounded size."""
    least = (_least(df, max_sample_values).groupBy("ordinal").agg(F.array_sort(F.collect_list(F.struct(*SLOTS))).alias("least")))
    return (_raw_stats(df).join(distinct_sketches(df), "ordinal", "left").join(least, "ordinal", "left")
            .withColumn("max_samples", F.lit(max_sample_values).cast("int")))


def merge_states(states: list[DataFrame] | DataFrame) -> DataFrame:
    """States of parts of one table (given as frames, or as one frame of all their rows) as the state of
    all rows. Samples are as many as the state with the fewest holds."""
    rows = reduce(lambda a, b: a.unionByName(b), states) if isinstance(states, list) else states
    merged = rows.groupBy("column_name", "ordinal", "dtype").agg(
        *[F.sum(c).alias(c) for c in ("row_count", "null_count")], *[F.min(c).alias(c) for c in ("min_value", "min_length", "max_samples")],
        *[F.max(c).alias(c) for c in ("max_value", "max_length")], *[F.bool_and(c).alias(c) for c in ("looks_like_email", "looks_like_date")],
        F.theta_union_agg("sketch", F.lit(SKETCH_BITS)).alias("sketch"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("least")))).alias("least"))
    return merged.withColumn("least", F.slice("least", 1, F.col("max_samples"))).select(*rows.columns)


def profile_of(state: DataFrame, df: DataFrame, cut: bool = True) -> DataFrame:
    """The profile that a state holds; ``df`` gives the column types alone."""
    values = state.select("ordinal", F.posexplode("least").alias("_at", "_v")).select(
        "ordinal", (F.col("_at") + 1).alias("sample_rank"), *[F.col(f"_v.{c}").alias(c) for c in SLOTS])
    text = truncate_text(_render(df)) if cut else _render(df)
    samples = _listed(values.select("ordinal", "sample_rank", text.alias("sample_value")))
    stats = _shown_stats(state).withColumn("distinct_count", _estimate(F.col("sketch")))
    return _complete(stats.join(samples, "ordinal", "left"))


# ---- F11: candidate rules from a profile ----------------------------------------

ALLOWED_MAX_VALUES = 10  # our cut-off: a text column with this few values gets an allowed list


def whole_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, values): all distinct values of columns known to hold few, whole and sorted."""
    row = df.agg(*[F.array_sort(F.collect_set(F.col(f"`{c}`"))).alias(f"v{i}") for i, c in enumerate(columns)])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias("values")) for i, c in enumerate(columns)]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def suggest_rules(df: DataFrame, prof: DataFrame | None = None) -> DataFrame:
    """(column_name, test_key, test_value) candidates, within the rule vocabulary.

    no nulls -> is_nullable NO; all values distinct -> distinct; e-mail shaped ->
    regex; few text values -> allowed (sorted, as a JSON array);
    numbers -> min/max; text -> min_length/max_length. One profile answers all: its
    samples are the values of a column that has few; where these are longer than samples hold, they
    are fetched whole, ``ALLOWED_MAX_VALUES`` a column at most. A ``prof`` given must hold
    ``ALLOWED_MAX_VALUES`` samples, uncut. The profile, a row per column, is collected.
    """
    prof = prof if prof is not None else profile(df, max_sample_values=ALLOWED_MAX_VALUES, cut=False)
    p = local_frame(df.sparkSession, prof.collect(), prof.schema)
    text = F.col("dtype") == "string"
    numeric = F.col("min_value").isNotNull()
    has_rows = F.col("row_count") > 0
    few = F.col("distinct_count").between(1, ALLOWED_MAX_VALUES)
    long = [r["column_name"] for r in p.where(text & few & (F.col("max_length") > KEY_TEXT)).collect()]
    p = p.withColumn("values", F.col("sample_values"))
    if long:
        p = (p.drop("values").join(whole_values(df, long), "column_name", "left")
             .withColumn("values", F.coalesce("values", "sample_values")))
    p = p.withColumn("_allowed", F.when(text & few, F.to_json(F.array_sort("values"))))
    num_text = lambda c: F.col(c).cast("string")
    cands = [
        F.when(has_rows & (F.col("null_count") == 0), F.struct(F.lit("is_nullable").alias("k"), F.lit("NO").alias("v"))),
        F.when(has_rows & (F.col("null_count") == 0) & (F.col("distinct_count") == F.col("row_count")),
               F.struct(F.lit("distinct").alias("k"), F.lit("true").alias("v"))),
        F.when(text & F.col("looks_like_email"), F.struct(F.lit("regex").alias("k"), F.lit(EMAIL_PATTERN).alias("v"))),
        F.when(text & F.col("_allowed").isNotNull() & (F.col("distinct_count") < F.col("row_count")),
               F.struct(F.lit("allowed").alias("k"), F.col("_allowed").alias("v"))),
        F.when(numeric, F.struct(F.lit("min").alias("k"), num_text("min_value").alias("v"))),
        F.when(numeric, F.struct(F.lit("max").alias("k"), num_text("max_value").alias("v"))),
        F.when(text & F.col("min_length").isNotNull(),
               F.struct(F.lit("min_length").alias("k"), num_text("min_length").alias("v"))),
        F.when(text & F.col("max_length").isNotNull(),
               F.struct(F.lit("max_length").alias("k"), num_text("max_length").alias("v"))),
    ]
    return (p.select("column_name", F.explode(F.array(*cands)).alias("c"))
            .where(F.col("c").isNotNull())
            .select("column_name", F.col("c.k").alias("test_key"), F.col("c.v").alias("test_value")))


def candidate_rule_logic(suggestions: DataFrame) -> DataFrame:
    """Group suggestions per column into one JSON rule text (sorted keys)."""
    typed = F.when(F.col("test_key").isin("min", "max", "min_length", "max_length"),
                   F.col("test_value"))
    as_json = (F.when(F.col("test_key") == "distinct", F.lit("true"))
               .when(F.col("test_key") == "allowed", F.col("test_value"))
               .when(typed.isNotNull(), typed)
               .otherwise(F.to_json(F.array(F.col("test_value"))).substr(F.lit(2), F.length(
                   F.to_json(F.array(F.col("test_value")))) - 2)))
    pair = F.concat(F.lit('"'), F.col("test_key"), F.lit('": '), as_json)
    return (suggestions.groupBy("column_name")
            .agg(F.array_sort(F.collect_list(pair)).alias("_pairs"))
            .select("column_name", F.concat(F.lit("{"), F.concat_ws(", ", "_pairs"), F.lit("}")).alias("rule_logic")))


def profile_file(spark, path: str, max_sample_values: int = 5) -> DataFrame:
    """read a sample file by its extension (S12) and profile it."""
    from tessera.sources.readers import load_sample
    return profile(load_sample(spark, path), max_sample_values=max_sample_values)
