"""Secret scan: fixed formats plus password guess-cost over credential contexts.

Base spans come from three fixed patterns. On top, every value that stands in
a credential context (``pwd: x``, ``Bearer x``, ``passphrase is x`` ...) is
segmented at least cost into words, dates, repeats, keyboard walks, runs of
consecutive characters and brute-force characters; values that need at least
``min_bits`` bits of guesses give a span of kind ``guess``.

The word costs come from the scanned corpus itself: a word belongs to the
dictionary if at least a share of ``2 ** -WORD_BITS`` of all words outside
credential contexts equals it, so the dictionary never has more than
``2 ** WORD_BITS`` entries, whatever the size of the corpus.

Defined cases: null or empty texts give no span (and the digest of the empty
string); texts of any length are scanned whole, in linear time; null ids are kept; repeated rows are scanned each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import portions, stored

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Up to where the value of a credential begins; group 1: the word, 2: a separator with a sign, 3: the white space
#: behind it, 4: an opening quote. The value is not part of the match, so that a value which is a context word
#: itself ("bearer token: x") begins a match of its own.
CONTEXT = re.compile(
    r"""((?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|(?:api|access|auth|private)[_-]?key|bearer|(?<=[A-Za-z0-9])[_-]key)"""
    r"""(?:[_-](?:key|secret|token|value|string|password|phrase))*)["']?"""
    r"""(?:([\x20\t]*(?::=|=>|[:=]))(\s*)|[\x20\t]+(?:is[\x20\t]+)?)(["'<]?)(?=[^\s"'<>,;])""", re.I | re.A)
VALUE = re.compile(r"""[^\s"'<>,;]+""")
SIGN_INSIDE = re.compile(r"[^\w\s.'’/_-].*\w", re.S)
WORD = re.compile(r"[a-z]{3,}")
WORD_BITS = 18
MAX_WORD = 24

# Frequent parts of passwords and place holders.
COMMON = (
    "password passwd pass secret token admin administrator root user login guest default changeme change "
    "welcome letmein master monkey dragon shadow sunshine princess football baseball superman batman "
    "iloveyou love hello freedom whatever trustno test testing example sample demo dummy placeholder "
    "your here none null true false undefined value string key xxxx redacted hidden"
).split()
# Rows of a keyboard and signs that stand for letters.
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("013457@$!", "oieastasi")


def _neighbours() -> set[tuple[str, str]]:
    at = {c: (x + y / 2, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    return {(a, b) for a, (x, y) in at.items() for b, (v, w) in at.items() if a != b and abs(x - v) <= 1 and abs(y - w) <= 1}


WALK = _neighbours()
DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"
                  r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)?\d\d|(?:19|20)\d\d")


def guess_bits(value: str, words: dict[str, float]) -> float:
    """Base-2 logarithm of the guesses that ``value`` needs: least-cost segmentation.

    One pass over the characters with a constant number of open segment kinds
    (walk, run, repeats of period 1 to 4) and of word or date ends, so the
    time is linear in the length. ``words`` has the bits of each word.
    """
    n = len(value)
    low = value.lower()
    plain = low.translate(LEET)
    classes = ((str.isdigit, 10), (str.islower, 26), (str.isupper, 26))
    size = sum(k for test, k in classes if any(map(test, value))) + 33 * any(not c.isalnum() for c in value)
    char = math.log2(size or 26)
    dates = {}
    for i in range(n):
        if value[i].isdigit() and (m := DATE.match(value, i)):
            for end in {m.end(), i + 4 if value[i:i + 2] in ("19", "20") and value[i:i + 4].isdigit() else m.end()}:
                dates.setdefault(end, []).append((i, math.log2(200) if end - i <= 4 else math.log2(200 * 365) + 2))
    inf = math.inf
    best = [0.0] + [inf] * n
    walk = run = inf
    repeat = [inf] * 5
    for i in range(n):
        cost = best[i] + char
        new_walk = new_run = inf
        if i:
            if (low[i - 1], low[i]) in WALK:
                new_walk = min(walk, best[i] + 2) + 2.0
            step = ord(value[i]) - ord(value[i - 1])
            if abs(step) == 1 and value[i].isalnum() and value[i - 1].isalnum():
                new_run = min(run if i > 1 and step == ord(value[i - 1]) - ord(value[i - 2]) else inf, best[i] + 2) + 0.5
        walk, run = new_walk, new_run
        for u in range(1, 5):
            repeat[u] = min(repeat[u], best[i] + 2) + 0.25 if i >= u and value[i] == value[i - u] else inf
        cost = min(cost, walk, run, *repeat)
        for start, bits in dates.get(i + 1, ()):
            cost = min(cost, best[start] + bits + 1)
        for start in range(max(0, i + 1 - MAX_WORD), i - 1):
            bits = words.get(low[start:i + 1])
            extra = 1.0
            if bits is None:
                bits, extra = words.get(plain[start:i + 1]), 3.0
            if bits is not None:
                part = value[start:i + 1]
                cost = min(cost, best[start] + bits + extra + (0 if part.islower() else 1 if part.isupper() or part.istitle() else 3))
        best[i + 1] = cost
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def value_end(text: str, m: re.Match) -> tuple[int, bool]:
    """End of the value behind a context, and whether it is a quoted one with blanks.

    A quoted value of a password or phrase goes to the closing quote of its
    line; every other value ends at white space, a quote, bracket, comma or
    semicolon.
    """
    start, quote = m.end(), m.group(4)
    end = VALUE.match(text, start).end()
    if m.group(2) and quote in ('"', "'") and m.group(1)[:2].lower() in ("pa", "pw"):
        close = text.find(quote, end)
        if close > end and text.find("\n", end, close) < 0:
            return close, True
    return end, False


def guess_spans(text: str, words: dict[str, float], min_bits: float) -> list[tuple[int, int, str, float]]:
    """Strong values in credential contexts.

    Without a sign between key and value, or with a line feed between them,
    the value must mix letters with digits or with signs inside it (hyphens,
    points, slashes and apostrophes are no such signs), so that prose after
    "token" or "pass" is left alone. What lies inside a value that was costed
    is not costed again.
    """
    out, costed = [], 0
    for m in CONTEXT.finditer(text):
        start = m.end()
        if start < costed:
            continue
        end, quoted = value_end(text, m)
        value = text[start:end] if quoted else text[start:end].rstrip(".!?:)]}|")
        loose = not m.group(2) or "\n" in m.group(3)
        if len(value) < 6 or (loose and (value.isalpha() or not (any(c.isdigit() for c in value) or SIGN_INSIDE.search(value)))):
            continue
        costed = start + len(value)
        bits = guess_bits(value, words)
        if bits >= min_bits:
            out.append((start, start + len(value), "guess", bits))
    return out


def without_contexts(text: str) -> str:
    """``text`` without credential contexts and their values."""
    parts, at = [], 0
    for m in CONTEXT.finditer(text):
        if m.start() >= at:
            parts.append(text[at:m.start()])
        if m.end() >= at:
            at = value_end(text, m)[0]
    return " ".join([*parts, text[at:]])


def joined(spans: list[tuple]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in sorted(spans, key=lambda s: (s[0], order[s[2]], s[1])))


def word_table(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """Bits of every dictionary word, from counts over all texts.

    Counted in the tasks and merged by a grouped sum; only words above the
    relative frequency floor reach the driver (``2 ** WORD_BITS`` at most).
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush():
            return pa.RecordBatch.from_pydict({"w": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

        for batch in portions(batches):
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(WORD.findall(without_contexts(text).lower()))
                if len(seen) > 500_000:
                    yield flush()
                    seen.clear()
        if seen:
            yield flush()

    counts = docs.select(text_col).mapInArrow(count, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n"))
    counts = stored(counts)
    total = counts.agg(F.sum("n")).first()[0] or 0
    floor = total / 2 ** WORD_BITS
    frequent = counts.where((F.col("n") >= F.lit(floor)) & (F.length("w") <= MAX_WORD)).collect()
    words = {r["w"]: math.log2(total / r["n"]) for r in frequent}
    for rank, w in enumerate(COMMON, 1):
        words[w] = min(words.get(w, math.inf), math.log2(rank + 1))
    return words


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bits: float = 40.0,
                 words: dict[str, float] | None = None) -> DataFrame:
    """All spans of each text: ``id_col``, ``spans`` array of (kind, start, end, bits).

    Offsets are code points, end exclusive; ``bits`` is null for base spans.
    """
    words = word_table(docs, text_col) if words is None else words
    held = docs.sparkSession.sparkContext.broadcast(words)
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))
        for batch in portions(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                spans = [(*s, None) for s in base_spans(text)] + guess_spans(text, table, min_bits)
                order = {k: i for i, k in enumerate(KINDS)}
                spans.sort(key=lambda s: (s[0], order[s[2]], s[1]))
                rows.append([{"kind": s[2], "start": s[0], "end": s[1], "bits": s[3]} for s in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["id", "spans"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        scan, f"id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint,bits:double>>")
    return out.select(F.col("id").alias(id_col), "spans")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, joined spans and the hash of the base spans, from ``scan_secrets``."""
    def text_of(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count_of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(id_col, count_of("assign"), count_of("access"), count_of("hex"),
                        F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"),
                        count_of("guess"), F.array_max(F.transform("spans", lambda s: s["bits"])).alias("max_bits"))
