"""Filter interaction audit by incremental retraction over a file stream.

All files of the table are read as available-now micro-batches. Every batch
is reduced to narrow rows (id, part, failure bits, labels, text digest) and
then merged, once per batch id, with two tables in the shared folder:

* text state: the smallest id that each text has been seen under, with the
  rows that carry it. Rows are only appended; ids only fall, so the current
  state of a text is its minimum over all batches before this one;
* part counters: signed counts per (part, failure bits, labels). A text's
  rows count as failing E until they hold its smallest id; when a smaller id
  arrives, the masks counted for the earlier one are retracted.

A batch writes into folders named after its id, so a batch that runs again
after a lost driver or executor replaces its own rows. The report needs the
summed counters alone: at most 32 masks a part, whatever the table's size.

Scale: texts are scanned once and never shuffled; a text is keyed by its
SHA-256. Every aggregate combines in the map tasks, and the joins are on
(digest, id) or on one row a digest, so neither a text nor a source that
holds a third of all rows gathers in one task. ``batches`` bounds how often
the state and the labels are read again, at any size.

Rows: a null text is empty (it fails A only); a null source is the part '';
a row without id is a copy of nothing, has no label and no text counts as a
copy of it; repeated rows all count, and rows of one text that share its
smallest id all pass E; labels that repeat for an id are combined (1 if any
is 1); columns other than doc_id, text and source are not read; an empty
table gives no rows. Texts of any length are scanned whole.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrail.config import work_dir
from tabrail.llm.common import table

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
MASKS = range(1 << len(FILTERS))
ROW = "digest binary, doc_id long, part string, mask int, good int, toxic int, n long"
COUNTER = "part string, mask int, good int, toxic int, n long"

#: Micro-batches that the files are dealt into, by their bytes.
BATCHES = 4

#: Fixed values of the report's contract.
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 2
SYMBOLS = "[#$%&*|]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def failures(text: Column, words: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    fails = [n < LEAST_WORDS, distinct * 100 < n * DISTINCT_PERCENT,
             upper * 100 > F.length(text) * UPPER_PERCENT, text.rlike(SYMBOLS)]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).cast("int")


def narrow(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest and mask (A to D) of every row: one scan, no shuffle."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("t"))
            .withColumn("words", words)
            .select("doc_id", "part", F.unhex(F.sha2("t", 256)).alias("digest"), failures(F.col("t"), F.col("words")).alias("mask")))


def file_stream(spark: SparkSession, path: str, batches: int = BATCHES) -> DataFrame:
    """The table's files as a stream that takes about 1/``batches`` of their bytes a trigger."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    total = fs.getContentSummary(p).getLength()
    # A stream takes folders or patterns; a table of one file is a pattern of its own name.
    taken = path if fs.getFileStatus(p).isDirectory() else f"{path[:-1]}[{path[-1]}]"
    return (spark.readStream.schema(spark.read.parquet(path).schema)
            # Files that are much older than the newest are still part of the table.
            .option("maxFileAge", "36500d")
            .option("maxBytesPerTrigger", max(1, -(-int(total) // batches)))
            .parquet(taken))


class Audit:
    """Text state and part counters in ``root``, merged batch by batch."""

    def __init__(self, spark: SparkSession, labels: DataFrame, root: str):
        self.spark, self.root, self.done = spark, root, []
        one = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)
        known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality"), one("toxic"))
        known.withColumnRenamed("quality", "good").write.mode("overwrite").parquet(f"{root}/labels")
        self.labels = spark.read.parquet(f"{root}/labels")

    def _at(self, kind: str, batch: int) -> str:
        return f"{self.root}/{kind}/{batch:06d}"

    def _read(self, kind: str, schema: str, before: int) -> DataFrame:
        paths = [self._at(kind, b) for b in self.done if b < before]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Merge one micro-batch: append smaller ids to the state, write its counter changes."""
        narrow(batch).write.mode("overwrite").parquet(self._at("rows", batch_id))
        # Read in the caller's session: streams run without adaptive plans.
        rows = self.spark.read.parquet(self._at("rows", batch_id))
        per_id = rows.groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
        labelled = per_id.where("doc_id is not null").join(self.labels, "doc_id", "left")
        none = per_id.where("doc_id is null").withColumns({"good": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")})
        whole = labelled.unionByName(none).select("digest", "doc_id", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), "n")
        whole.write.mode("overwrite").parquet(self._at("whole", batch_id))
        whole = self.spark.read.schema(ROW).parquet(self._at("whole", batch_id))

        lowest = lambda df, name: df.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias(name))
        state = self._read("state", ROW, batch_id)
        moved = lowest(whole, "low").join(lowest(state, "old"), "digest", "left").where("old is null or low <= old")
        moved.write.mode("overwrite").parquet(self._at("moved", batch_id))
        moved = self.spark.read.schema("digest binary, low long, old long").parquet(self._at("moved", batch_id))

        firsts = whole.join(moved.select("digest", F.col("low").alias("doc_id")), ["digest", "doc_id"])
        firsts.select(*whole.columns).write.mode("overwrite").parquet(self._at("state", batch_id))
        firsts = self.spark.read.schema(ROW).parquet(self._at("state", batch_id))
        late = state.join(moved.where("low < old").select("digest", F.col("old").alias("doc_id")), ["digest", "doc_id"])

        copy = F.when(F.col("doc_id").isNull(), 0).otherwise(COPY)
        changes = [whole.withColumn("mask", F.col("mask") + copy)]
        for rows_, sign in ((firsts, 1), (late, -1)):
            changes.append(rows_.withColumn("n", F.col("n") * sign))
            changes.append(rows_.withColumns({"mask": F.col("mask") + COPY, "n": F.col("n") * -sign}))
        total = None
        for c in changes:
            c = c.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
            total = c if total is None else total.unionByName(c)
        total.select("part", "mask", "good", "toxic", "n").write.mode("overwrite").parquet(self._at("counters", batch_id))
        if batch_id not in self.done:
            self.done.append(batch_id)

    def counters(self) -> DataFrame:
        """part, mask (A to E), good, toxic, n: the counts after all merged batches."""
        every = self._read("counters", COUNTER, max(self.done, default=-1) + 1)
        return every.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n != 0")


def report(counters: DataFrame) -> DataFrame:
    """One row per part, filter order and step.

    A part becomes one row of 32 masks; each of its 600 lines is a sum over
    them. A row that fails k filters is removed by each of them in 120 / k of
    the orders, which gives the shapley counts.
    """
    def of(weight: Column, name: str) -> list[Column]:
        return [F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, weight)), F.lit(0)) for m in MASKS]).alias(name)]

    n = F.col("n")
    parts = counters.groupBy("part").agg(*of(n, "all"), *of(n * F.col("good"), "good"), *of(n * F.col("toxic"), "bad"))
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for i, f in enumerate(order):
            bit = 1 << FILTERS.index(f)
            steps.append(("".join(order), i + 1, f, before, bit))
            before |= bit
    fields = ("filter_order", "step", "filter", "before", "bit")
    line = F.from_json(F.lit("[" + ",".join(
        '{"filter_order":"%s","step":%d,"filter":"%s","before":%d,"bit":%d}' % s for s in steps) + "]"),
        "array<struct<filter_order string, step int, filter string, before int, bit int>>")
    rows = parts.select("*", F.explode(line).alias("s")).select("part", "all", "good", "bad", *[F.col(f"s.{f}").alias(f) for f in fields])

    def total(name: str, take: str, times: str = "1L") -> Column:
        return F.expr(f"aggregate(sequence(0, {len(MASKS) - 1}), 0L, (s, m) -> s + IF({take}, `{name}`[m] * {times}, 0L))")

    fails, seen = "(m & bit) != 0", "(m & before) != 0"
    return rows.select(
        "part", "filter_order", "step",
        total("all", "(m & (before | bit)) = 0").alias("kept"),
        total("all", f"{fails} AND NOT {seen}").alias("removed"),
        total("all", f"{fails} AND {seen}").alias("redundant"),
        total("all", "m = bit").alias("unique_fails"),
        total("good", f"{fails} AND NOT {seen}").alias("good_lost"),
        total("bad", f"{fails} AND NOT {seen}").alias("toxic_lost"),
        total("all", fails, "(120L div bit_count(m))").alias("shapley"),
        "filter")


def audit_filters(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Stream the files of ``path`` through the audit and report on them."""
    root = work_dir(spark, "filter-audit")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(p)
    audit = Audit(spark, labels, root)
    query = (file_stream(spark, path, batches).writeStream.foreachBatch(audit.merge)
             .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    out = report(audit.counters())
    # The report needs the counters alone.
    for kind in ("rows", "whole", "moved", "state", "labels"):
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{kind}"), True)
    return out


def op13_retraction_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(spark, f"{sf_dir.rstrip('/')}/documents.parquet", table(spark, sf_dir, "labels"))


_ORDERS = ", ".join(f"('{''.join(o)}')" for o in permutations(FILTERS))
SQL = f"""WITH l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id),
w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low
  FROM documents),
d AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
         len(words) < 200 AS fa, 100 * len(list_distinct(words)) < 50 * len(words) AS fb,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS fc,
         regexp_matches(t, '[#$%&*|]') AS fd, coalesce(w.doc_id > low, false) AS fe
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (
  SELECT part, (CASE WHEN fa THEN 'A' ELSE '' END) || (CASE WHEN fb THEN 'B' ELSE '' END) || (CASE WHEN fc THEN 'C' ELSE '' END)
         || (CASE WHEN fd THEN 'D' ELSE '' END) || (CASE WHEN fe THEN 'E' ELSE '' END) AS fails,
         count(*) AS n, sum(good) AS good, sum(bad) AS bad
  FROM d GROUP BY ALL),
o AS (
  SELECT filter_order, step, filter_order[step] AS filter, filter_order[1:step - 1] AS earlier
  FROM (VALUES {_ORDERS}) AS v(filter_order), range(1, 6) AS r(step)),
x AS (
  SELECT part, filter_order, step, filter, n, good, bad, fails, contains(fails, filter) AS hit,
         earlier <> '' AND regexp_matches(fails, '[' || earlier || '-]') AS gone
  FROM m CROSS JOIN o),
r AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step,
         CAST(coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (WHERE hit AND gone), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (WHERE fails = filter), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (WHERE hit AND NOT gone), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(bad) FILTER (WHERE hit AND NOT gone), 0) AS BIGINT) AS toxic_lost,
         filter
  FROM x GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley, filter
FROM r"""
