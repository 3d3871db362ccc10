"""Cross-site boilerplate lines by distinct-site spread. DataFrame functions only.

A line is what stands between line feeds, without blanks, tabs and carriage
returns at its ends; lines of fewer than ``min_words`` words (by default:
one word, as headings and closing brackets are) never count. A site speaks for a line through one text, that of least
digest among its texts with the line; sites that speak through the same text
count once. So a document that is copied as a whole to many sites makes no
boilerplate of its own lines, but a line that other texts share is taken out
of every text, copies included, however little else they hold.

Lines on one site or in one text only (least and greatest agree) need no
sketch. For the others, HyperLogLog sketches of the speaking texts merge by
aggregation per line hash; an estimate within ``band`` of the threshold is
replaced by the exact number. Lines on ``min_sites`` sites or more are
boilerplate.

Only texts that hold a boilerplate line are cut; the others pass through
unchanged.

Defined cases: a null site is a site of its own; null texts stay null and have
no lines; empty lines stay; a text of boilerplate only becomes empty; repeated
rows are treated alike; texts of any length are split as a whole; an empty
table gives no rows; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import fresh, stored

ENDS = " \t\r"


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(ENDS))


def counts_as_line(line: Column, min_words: int) -> Column:
    return line.rlike("[ \\t]+".join(["[^ \\t]+"] * min_words))


def digest(text: Column) -> Column:
    """60 bits of the MD5 of a text as a long."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def boilerplate_lines(docs: DataFrame, text_col: str = "text", site_col: str = "source", min_sites: int = 10,
                      min_words: int = 2, lg_k: int = 12, band: float = 0.1) -> DataFrame:
    """Hashes of the boilerplate lines with their number of sites: (line_hash, sites)."""
    lines = (docs.select(F.xxhash64(F.col(site_col).cast("string"), F.col(site_col).isNull()).alias("site"),
                         digest(F.col(text_col)).alias("own"), F.explode(F.split(text_col, "\n", -1)).alias("line"))
             .select("site", "own", trimmed(F.col("line")).alias("line")).where(counts_as_line(F.col("line"), min_words))
             .select("site", "own", F.xxhash64("line").alias("line_hash")))
    spread = (lines.groupBy("line_hash").agg(F.min("site").alias("a"), F.max("site").alias("b"), F.min("own").alias("c"), F.max("own").alias("d"))
              .where("a <> b and c <> d").select("line_hash"))
    once = lines.groupBy("line_hash", "site").agg(F.min("own").alias("own"))  # a very common line shrinks to a row per site
    pairs = stored(once.join(spread, "line_hash", "left_semi"))
    sketched = pairs.groupBy("line_hash").agg(F.hll_sketch_estimate(F.hll_sketch_agg("own", lg_k)).alias("sites"))
    sketched = stored(sketched.where(F.col("sites") >= F.lit(min_sites * (1 - band) - 1)))
    near = F.abs(F.col("sites") - min_sites) <= F.lit(min_sites * band + 1)
    exact = (pairs.join(sketched.where(near).select("line_hash"), "line_hash", "left_semi").select("line_hash", "own").distinct()
             .groupBy("line_hash").agg(F.count(F.lit(1)).alias("sites")))
    return sketched.where(~near).unionByName(exact).where(F.col("sites") >= min_sites)


def remove_boilerplate(docs: DataFrame, text_col: str = "text", site_col: str = "source", min_sites: int = 10,
                       min_words: int = 2) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text_col``.

    Adds ``n_lines`` and ``n_removed`` (long), replacing columns of that name.
    """
    key, bad, line, parts, rest = fresh(docs, "key", "bad", "line", "parts", "rest")
    docs = docs.drop("n_lines", "n_removed")
    text = F.col(f"`{text_col}`")
    remove = boilerplate_lines(docs, text_col, site_col, min_sites, min_words).select("line_hash")
    found = (docs.where(text.isNotNull()).select(F.xxhash64(text).alias(key), F.explode(F.split(text, "\n", -1)).alias(line))
             .select(key, trimmed(F.col(line)).alias(line)).where(counts_as_line(F.col(line), min_words))
             .select(key, F.xxhash64(line).alias("line_hash")).join(remove, "line_hash", "left_semi")
             .groupBy(key).agg(F.collect_set("line_hash").alias(bad)))
    # stored: the join then reads two exchanges, and a group of equal texts can be split over tasks
    out = docs.withColumn(key, F.xxhash64(text)).join(stored(found), key, "left")
    out = out.withColumn(parts, F.split(text, "\n", -1))

    def is_bad(x: Column) -> Column:
        return F.array_contains(F.col(bad), F.xxhash64(trimmed(x))) & counts_as_line(trimmed(x), min_words)

    hit = F.col(bad).isNotNull()
    out = out.withColumn(rest, F.when(hit, F.filter(parts, lambda x: ~is_bad(x))))
    kept = F.when(hit, F.array_join(rest, "\n")).otherwise(text)
    cols = [kept.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*cols, F.when(text.isNull(), 0).otherwise(F.size(parts)).cast("bigint").alias("n_lines"),
                      F.when(hit, F.size(parts) - F.size(rest)).otherwise(0).cast("bigint").alias("n_removed"))


#: The same in DuckDB over ``documents`` (doc_id, n_lines, n_removed, text).
ORACLE = """
WITH lines AS (
  SELECT source, ('0x' || md5(text)[1:15])::BIGINT AS own,
         trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) AS line FROM documents),
speaks AS (
  SELECT line, source, min(own) AS own FROM lines WHERE regexp_matches(line, '{two}') GROUP BY line, source),
remove AS (
  SELECT line FROM speaks GROUP BY line HAVING count(DISTINCT own) >= 10),
own AS (
  SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
hit AS (
  SELECT r, i, x, (m.line IS NOT NULL) AS bad
  FROM (SELECT r, unnest(parts) AS x, generate_subscripts(parts, 1) AS i FROM own) q
  LEFT JOIN remove m ON trim(q.x, ' ' || chr(9) || chr(13)) = m.line),
per AS (
  SELECT r, count(*) AS n, count(*) FILTER (WHERE bad) AS n_bad,
         coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (WHERE NOT bad), '') AS rest
  FROM hit GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_lines, coalesce(n_bad, 0) AS n_removed,
       CASE WHEN n_bad > 0 THEN rest ELSE text END AS text
FROM own LEFT JOIN per USING (r)
""".format(two="[^ \\t]+[ \\t]+[^ \\t]+")
