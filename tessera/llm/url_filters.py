"""URL filters as a sort-merge range join, in DataFrame functions throughout.

A rule is a host and a path; it fits its host and all subdomains, where the URL's path
starts with the rule's. Canonical keys are the host's labels reversed, a separator, and
the path, as bytes: so a rule is the interval of all keys its own key is a prefix of, and
intervals nest or are apart. A URL is probed once per host depth that rules have.

The interval ends are swept once in key order with a stack of the open rules; each end is
a boundary that carries the innermost rule open from there on. Probes are dealt evenly by
row (so a host, page or copy that holds a third of all rows is no task of its own), every
part gets the boundaries, is sorted by key, and one pass over it merges the two: a probe's
rule is the one its last boundary carries. Of the probes of a URL the longest host wins,
and within a host the longest path; of equal rules block wins.

The rule list is a parameter held by the driver; parts multiply it, pages do not.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path:
then up to ``?``, ``#`` or the end. NULL urls and those without ``://`` have both empty
and fit no rule; like other urls without a rule they get the default verdict. NULL ids
and repeated rows are kept, one result row each. Empty tables give empty results, an empty
rule list the default for all; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, shuffle_partitions

SEPARATOR, END = b"\xfe", b"\xff"   # neither occurs in UTF-8
PARTS_PER_PARTITION = 8


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str = "/"

    @property
    def key(self) -> bytes:
        return ".".join(reversed(self.host.split("."))).encode() + SEPARATOR + self.path.encode()


def boundaries(rules: Sequence[Rule]) -> list[tuple[bytes, str | None, str | None]]:
    """Sweep of the rules' interval ends: (key, rule, verdict) of the innermost rule from each key on."""
    best: dict[bytes, Rule] = {}
    for rule in rules:
        if rule.key not in best or rule.verdict == "block":
            best[rule.key] = rule
    out, open_ = [], []

    def close():
        key = open_.pop()
        top = best[open_[-1]] if open_ else None
        out.append((key + END, top and top.host + top.path, top and top.verdict))

    for key in sorted(best):
        while open_ and not key.startswith(open_[-1]):
            close()
        open_.append(key)
        out.append((key, best[key].host + best[key].path, best[key].verdict))
    while open_:
        close()
    return out


def url_verdicts(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
                 default: str = "allow") -> DataFrame:
    """Per page: id, host, path, rule, verdict."""
    spark = pages.sparkSession
    parts = shuffle_partitions(spark) * PARTS_PER_PARTITION
    depths = sorted({rule.host.count(".") + 1 for rule in rules})
    url = F.col(url_col).cast("string")
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    urls = (pages.select(F.col(id_col).alias("id"), rest.alias("rest"), F.monotonically_increasing_id().alias("row"))
            .select("id", "row", ascii_lower(F.regexp_extract("rest", "^([^/?#]*)", 1)).alias("host"),
                    F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path"))
            .withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
            .withColumn("labels", F.when(F.col("host") != "", F.reverse(F.split("host", r"\.")))))
    wanted = F.filter(F.array(*map(F.lit, depths)).cast("array<int>"), lambda d: d <= F.size("labels"))
    probes = (urls.withColumn("depth", F.explode_outer(F.when(F.col("labels").isNotNull(), wanted)))
              .withColumn("key", F.concat(F.array_join(F.slice("labels", 1, F.col("depth")), ".").cast("binary"),
                                          F.lit(SEPARATOR), F.col("path").cast("binary")))
              .select("part", "key", F.lit(1).alias("kind"), "row", "depth", "id", "host", "path",
                      F.lit(None).cast("struct<rule:string,verdict:string>").alias("top")))
    kind_of = {f.name: f.dataType for f in probes.schema.fields}
    ends = spark.createDataFrame(boundaries(rules), "key binary, rule string, verdict string").select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "key", F.lit(0).alias("kind"),
        *(F.lit(None).cast(kind_of[c]).alias(c) for c in ("row", "depth", "id", "host", "path")),
        F.struct("rule", "verdict").alias("top"))
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = (probes.unionByName(ends).withColumn("open", F.last("top", ignorenulls=True).over(sweep))
           .filter("kind = 1"))
    fits = F.when(F.col("key").isNotNull() & F.col("open.rule").isNotNull(),
                  F.struct("depth", F.col("open.rule").alias("rule"), F.col("open.verdict").alias("verdict")))
    judged = met.groupBy("part", "row").agg(F.first("id").alias("id"), F.first("host").alias("host"),
                                            F.first("path").alias("path"), F.max(fits).alias("best"))
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
                         F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
