"""Quality classifier: interpolated modified Kneser-Ney over characters.

Models are trained on the trusted documents of a language, whole texts: one for
each of ``FOLDS`` folds, from all the other folds, so that every trusted
document is scored out of sample. The remaining documents take the model
without fold 0, which has learnt as much as those that calibrate. N-grams are
runs of ``ORDER`` characters with start signs before each text, 12 bits a
character, so that context and suffix of an n-gram are shifts and masks. Tasks
count their n-grams, a grouped sum merges them; discounts, back-off weights and
probabilities come from grouped aggregates and joins of the count tables,
sharded by language and n-gram.

Scoring joins the positions of every text with the model, by language and
shard. A shard holds about ``SHARD_ROWS`` entries, cut by the two characters
before the predicted one (a position finds its whole back-off chain in one
shard). Tasks pack each shard into a hash table; the tables become files in the
shared folder, some at a time, that Spark hands to the executors, and scoring
tasks map them into memory. So the driver holds a few tables at a time and no
task holds more than it touches. The texts are scanned once for scores and are never
shuffled.

The log-perplexity per character of a text is compared with a quantile of the
out-of-sample values of its language's trusted documents. Short texts scatter
more, so the distance from the language's median is scaled by
``sqrt(n / (n + SHORT))`` first.

Defined cases: null and empty texts, and languages without trusted text (null
included), have no perplexity and are kept; a language whose trusted documents
are all in one fold, or all alike, has no limit and keeps everything; texts of
any length are whole; repeated rows are scored each; null ids are kept;
conflicting repeated labels of an id make it untrusted; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import broadcast_if_small, portions, put_file, stored
from riskframe.session import written

ORDER = 5
BITS = 12
MASK = (1 << BITS) - 1
EXACT = 3071  # code points below get a symbol each; the rest share 1,024
SHARD_ROWS = 1_000_000
SHORT = 200
FOLDS = 2
OUTER = 0.005  # share of trusted documents beyond the limit
CHUNK = 1 << 18


def symbols(text: str) -> np.ndarray:
    """One symbol of 1 to 4095 per code point (0 is the start sign)."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where(cp < EXACT, cp + 1, EXACT + 1 + cp % 1024)


def keys_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-gram keys of all characters of ``texts`` and the number in each text."""
    start = np.zeros(ORDER - 1, np.int64)
    parts, sizes = [], []
    for t in texts:
        s = symbols(t)
        sizes.append(len(s))
        parts += [start, s]
    flat = np.concatenate(parts) if parts else start
    key = flat.copy()
    for k in range(1, ORDER):
        key[k:] |= flat[:-k] << (BITS * k)
    return key[flat > 0], np.asarray(sizes)


def by_chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Slices of ``texts`` with about CHUNK characters each."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def ngram_counts(texts: DataFrame) -> DataFrame:
    """(lang, g, c) over a (lang, text) table."""
    def merge(old, key):
        k, c = np.unique(key, return_counts=True)
        if old is None:
            return k, c
        both = np.concatenate([old[0], k])
        order = np.argsort(both, kind="stable")
        both, c = both[order], np.concatenate([old[1], c])[order]
        first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
        return both[first], np.add.reduceat(c, first)

    def out(lang, held):
        for k in range(0, len(held[0]), 200_000):
            n = len(held[0][k:k + 200_000])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array(held[0][k:k + 200_000]), pa.array(held[1][k:k + 200_000])], names=["lang", "g", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple] = {}
        for batch in portions(batches):
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    by.setdefault(lang, []).append(text)
            for lang, own in by.items():
                for a, b in by_chunks(own):
                    held[lang] = merge(held.get(lang), keys_of(own[a:b])[0])
                    if len(held[lang][0]) > 1_000_000:
                        yield from out(lang, held.pop(lang))
        for lang, h in held.items():
            yield from out(lang, h)

    return texts.select("lang", "text").mapInArrow(run, "lang string, g bigint, c bigint").groupBy("lang", "g").agg(F.sum("c").alias("c"))


def discount(c: Column, d: str) -> Column:
    return F.when(c == 1, F.col(d)[0]).when(c == 2, F.col(d)[1]).otherwise(F.col(d)[2])


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, tag, g, v): log probabilities (tag = order 1 to 5), log back-off
    weights (tag = 8 + context length) and the unknown symbol (tag 0).

    Lower orders count distinct left neighbours. The three discounts of an
    order come from its counts of counts and are kept inside [0, count].
    """
    level = written(counts, "ngrams")
    levels = {ORDER: level}
    for k in range(ORDER - 1, 0, -1):
        level = written(level.groupBy("lang", F.col("g").bitwiseAND(F.lit((1 << (BITS * k)) - 1)).alias("g")).agg(F.count(F.lit(1)).alias("c")), "ngrams")
        levels[k] = level
    done, lower = [], None
    for k in range(1, ORDER + 1):
        n = [F.count_if(F.col("c") == i).cast("double") for i in (1, 2, 3, 4)]
        tops = levels[k].groupBy("lang").agg(*[x.alias(f"n{i}") for i, x in enumerate(n, 1)])
        y = F.when((F.col("n1") > 0), F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(F.lit(0.5))

        def step(i, a, b, y=y):
            raw = F.when(F.col(a) > 0, i - (i + 1) * y * F.col(b) / F.col(a)).otherwise(F.lit(0.5 * i))
            return F.least(F.greatest(raw, F.lit(0.1)), F.lit(i - 0.05))

        tops = tops.select("lang", F.array(step(1, "n1", "n2"), step(2, "n2", "n3"), step(3, "n3", "n4")).alias("d"))
        rows = levels[k].join(F.broadcast(tops), "lang").withColumn("ctx", F.shiftright("g", BITS)).withColumn("cut", discount(F.col("c"), "d"))
        sums = rows.groupBy("lang", "ctx").agg(F.sum("c").cast("double").alias("total"), F.sum("cut").alias("freed"), F.count(F.lit(1)).alias("kinds"))
        sums = sums.select("lang", "ctx", "total", (F.col("freed") / F.col("total")).alias("back"), "kinds")
        rows = rows.select("lang", "ctx", "g", (F.col("c") - F.col("cut")).alias("left")).join(sums, ["lang", "ctx"])
        if k == 1:
            below = F.col("back") / (F.col("kinds") + 1)
            done.append(sums.select("lang", F.lit(0).alias("tag"), F.lit(0).cast("bigint").alias("g"), F.log(F.col("back") / (F.col("kinds") + 1)).alias("v")))
        else:
            rows = rows.withColumn("s", F.col("g").bitwiseAND(F.lit((1 << (BITS * (k - 1))) - 1))).join(lower, ["lang", "s"])
            below = F.col("back") * F.col("p")
            done.append(sums.select("lang", F.lit(8 + k - 1).alias("tag"), F.col("ctx").alias("g"), F.log("back").alias("v")))
        prob = written(rows.select("lang", "g", (F.col("left") / F.col("total") + below).alias("p")), "ngrams")
        done.append(prob.select("lang", F.lit(k).alias("tag"), "g", F.log("p").alias("v")))
        lower = prob.select("lang", F.col("g").alias("s"), "p")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


class Lookup:
    """Open-addressing table of (tag, key) -> float32 as numpy arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys, self.values = keys, values
        self.bits = len(keys).bit_length() - 1

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Lookup:
        size = 1 << max(4, (len(keys) * 5 // 4).bit_length())
        self = cls(np.zeros(size, np.uint64), np.zeros(size, np.float32))
        todo = np.arange(len(keys))
        at = self._slot(keys)
        while len(todo):
            free = self.keys[at[todo]] == 0
            trying = todo[free]
            self.keys[at[trying]] = keys[trying]  # of several for one place the last stays
            won = self.keys[at[trying]] == keys[trying]
            self.values[at[trying[won]]] = values[trying[won]]
            todo = np.concatenate([trying[~won], todo[~free]])
            at[todo] = (at[todo] + 1) & (size - 1)
        return self

    def packed(self) -> bytes:
        return self.keys.astype("<u8").tobytes() + self.values.astype("<f4").tobytes()

    @classmethod
    def mapped(cls, path: str) -> Lookup:
        """The table of a file, mapped into memory."""
        size = os.path.getsize(path) // 12
        whole = np.asarray(np.memmap(path, np.uint8, "r"))
        return cls(whole[:8 * size].view("<u8"), whole[8 * size:].view("<f4"))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values; NaN where a key is missing."""
        out = np.full(len(keys), np.nan, np.float32)
        at = self._slot(keys)
        held = self.keys[at]
        hit = held == keys
        out[hit] = self.values[at[hit]]
        todo = np.flatnonzero(~hit & (held != 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (held != 0)]
        return out


def tagged(tag: int, keys: np.ndarray) -> np.ndarray:
    return keys.astype(np.uint64) | np.uint64(tag << 60)


def log_probs(model: Lookup, unknown: float, keys: np.ndarray) -> np.ndarray:
    """Log probability at every position, by the highest order that the model has."""
    total = np.zeros(len(keys), np.float64)
    todo, key = np.arange(len(keys)), keys
    for k in range(ORDER, 0, -1):
        if not len(todo):
            break
        got = model.get(tagged(k, key))
        hit = ~np.isnan(got)
        total[todo[hit]] += got[hit]
        todo, key = todo[~hit], key[~hit]
        if k > 1:
            back = model.get(tagged(8 + k - 1, key >> BITS))
            total[todo] += np.where(np.isnan(back), 0, back)
            key = key & ((1 << (BITS * (k - 1))) - 1)
    total[todo] += unknown
    return total


def shard_of(two: Column, n: int) -> Column:
    return F.pmod(F.shiftright(two, BITS) * 31 + two.bitwiseAND(F.lit(MASK)), F.lit(n))


def model_files(model: DataFrame, n_shards: int) -> tuple[dict[str, float], dict[tuple[str, int], str]]:
    """Log probability of an unknown symbol by language, and the file of every
    (language, shard). Entries without two characters of context go to all shards."""
    two = F.when(F.col("tag").between(3, ORDER), F.shiftright("g", BITS)).when(F.col("tag") >= 10, F.col("g"))
    two = two.bitwiseAND(F.lit((1 << (2 * BITS)) - 1))
    every = F.sequence(F.lit(0), F.lit(n_shards - 1))
    rows = (model.where("tag > 0").withColumn("shard", F.explode(F.when(two.isNull(), every).otherwise(F.array(shard_of(two, n_shards).cast("int")))))
            .select("lang", "shard", "tag", "g", F.col("v").cast("float").alias("v")))

    def pack(t: pa.Table) -> pa.Table:
        tags, keys, values = (t.column(c).to_numpy() for c in ("tag", "g", "v"))
        data = Lookup.of(keys.astype(np.uint64) | (tags.astype(np.uint64) << np.uint64(60)), values).packed()
        return pa.table({"lang": [t.column("lang")[0].as_py()], "shard": pa.array([t.column("shard")[0].as_py()], pa.int32()), "data": pa.array([data], pa.binary())})

    tables = rows.groupBy("lang", "shard").applyInArrow(pack, "lang string, shard int, data binary")
    unknown = {r["lang"]: r["v"] for r in model.where("tag = 0").select("lang", "v").collect()}  # a row per language
    names = {}
    for r in tables.toLocalIterator():  # a few tables at a time
        names[r["lang"], r["shard"]] = put_file(model.sparkSession, bytes(r["data"]), "ngrams")
    return unknown, names


def score_texts(texts: DataFrame, model: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id, lang, text_hash, n, lp) of an (id, lang, text) table.

    ``n`` is the number of characters, ``lp`` the log probability of the text:
    null for languages without a model and for empty texts.
    """
    id_type = texts.schema["id"].dataType.simpleString()
    n_shards = max(1, -(-model.count() // shard_rows))
    unknown, names = model_files(model, n_shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[tuple[str, int], Lookup] = {}
        none = Lookup.of(np.zeros(0, np.uint64), np.zeros(0, np.float32))

        def table_of(lang: str, s: int) -> Lookup:
            if (lang, s) not in tables:
                tables[lang, s] = Lookup.mapped(SparkFiles.get(names[lang, s])) if (lang, s) in names else none
            return tables[lang, s]

        for batch in portions(batches):
            langs, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            total, size = np.full(len(texts), np.nan), np.array([len(t or "") for t in texts], dtype=np.int64)
            for lang in set(langs) & unknown.keys():
                at = [i for i, x in enumerate(langs) if x == lang and texts[i]]
                for a, b in by_chunks([texts[i] for i in at]):
                    keys, sizes = keys_of([texts[i] for i in at[a:b]])
                    keys, at_key = np.unique(keys, return_inverse=True)  # a chunk's n-grams once
                    lp = np.zeros(len(keys))
                    shard = (((keys >> (2 * BITS)) & MASK) * 31 + ((keys >> BITS) & MASK)) % n_shards
                    order = np.argsort(shard.astype(np.uint16 if n_shards <= 1 << 16 else np.int64), kind="stable")  # small numbers: radix sort
                    ends = np.r_[0, np.cumsum(np.bincount(shard, minlength=n_shards))]
                    for s in range(n_shards):
                        mine = order[ends[s]:ends[s + 1]]
                        if len(mine):
                            lp[mine] = log_probs(table_of(lang, s), unknown[lang], keys[mine])
                    total[at[a:b]] = np.add.reduceat(lp[at_key], np.cumsum(sizes) - sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(size),
                                              pa.array(total, pa.float64(), mask=np.isnan(total))], names=["id", "lang", "text_hash", "n", "lp"])

    return texts.select("id", "lang", "text", F.xxhash64("text")).mapInArrow(run, f"id {id_type}, lang string, text_hash bigint, n bigint, lp double")


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     label_col: str = "quality", outer: float = OUTER, shard_rows: int = SHARD_ROWS,
                     with_hash: bool = False) -> DataFrame:
    """``id_col``, lang, n_chars, log_perplexity, perplexity, high, distance, keep.

    Trusted documents are those labelled 1, in folds by crc32 of the id. The
    limit of a language is the ``1 - outer`` quantile of its trusted documents'
    scaled distances from their median, all out of sample: the larger of the
    observed quantile and that of a normal distribution of their spread, since
    few documents do not reach as far as their quantile. It is null, and
    everything kept, where it is missing or not above 0.
    ``with_hash`` adds ``text_hash`` (xxhash64 of the text).
    """
    trusted = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
               .agg(F.min(label_col).alias("least")).where("least = 1").select("id", F.lit(1).alias("t")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    texts = texts.join(broadcast_if_small(trusted), "id", "left")
    own = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(FOLDS)).cast("int")
    learn = texts.where("t = 1 and lang is not null").withColumn("own", own).withColumn("out", F.explode(F.sequence(F.lit(0), F.lit(FOLDS - 1))))
    model = kneser_ney(ngram_counts(learn.where("own <> out").select(F.concat_ws(":", "out", "lang").alias("lang"), "text")))
    # "fold:lang" names the model without that fold; a document that is not trusted takes the one without fold 0
    named = texts.select("id", F.concat(F.when(F.col("t") == 1, own).otherwise(0).cast("string"), F.lit(":"), "lang").alias("lang"), "text")
    scored = score_texts(named, model, shard_rows).withColumn("lang", F.substring("lang", 3, 1 << 30))
    scored = stored(scored.withColumn("h", F.when(F.col("n") > 0, -F.col("lp") / F.col("n"))).join(broadcast_if_small(trusted), "id", "left"))
    calibration = scored.where("t = 1 and h is not null")
    middle = F.broadcast(calibration.groupBy("lang").agg(F.percentile_approx("h", 0.5, 10_000).alias("middle")))
    away = (F.col("h") - F.col("middle")) * F.sqrt(F.col("n") / (F.col("n") + SHORT))
    limits = (calibration.join(middle, "lang").select("lang", away.alias("z")).groupBy("lang")
              .agg(F.greatest(F.percentile_approx("z", 1 - outer, 10_000), NormalDist().inv_cdf(1 - outer) * F.stddev("z")).alias("q")))
    limits = middle.join(limits, "lang", "left").select("lang", "middle", F.when(F.col("q") > 0, F.col("q")).alias("high"))
    out = scored.join(F.broadcast(limits), "lang", "left")
    keep = F.coalesce(away <= F.col("high"), F.lit(True))
    return out.select(F.col("id").alias(id_col), "lang", F.col("n").alias("n_chars"), F.col("h").alias("log_perplexity"),
                      F.exp("h").alias("perplexity"), "high", away.alias("distance"), keep.alias("keep"), *(["text_hash"] if with_hash else []))
