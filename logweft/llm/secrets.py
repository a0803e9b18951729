"""Secret scanning with a random forest that removes false positives.

Patterns find candidates: long unbroken runs of letters, digits and ``_+/-``, with ``=`` as padding at the end, that have
a digit or letters of both cases inside; and, from four characters on and of any kind, what is assigned to a name such
as ``password``.  Each becomes a row of numbers: its length, shares and transitions of character classes, how unusual
its pairs of characters are, how much of it dictionary words cover, what its document's path says, and which words
stand near it.  A random forest fitted on labelled findings gives the probability that it is a secret.

Labelled findings are a table of candidates with a label.  Where there is none, ``weak_labels`` gives a label to
candidates whose form settles the matter (a well-known issuer's form or a named assignment of random characters on
one side; parts of addresses and names, repeated characters, words on the other) and none to the rest.

Findings are rows where their text lies; the forest is fitted on a bounded sample of them (``train_rows``).  The
dictionary is counted over all documents, in one aggregation of words; it has the words that at least ``word_share`` of
the documents hold, so its size is at most the distinct words of a mean document divided by that share, however many
documents there are.  Scoring is one pass with no shuffle.

Defined cases: a null or empty text has no candidates; of candidates that overlap the earliest is taken, and of those
that start together the longest; a null path is the
empty path; without labelled findings of both kinds the probability is 0.5 and every candidate is kept; repeated
rows give repeated findings; other columns are ignored; a null id is carried along.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.llm.landing import landed


@dataclass(frozen=True)
class SecretConfig:
    train_rows: int = 20_000
    word_share: float = 0.001
    word_docs: int = 5
    trees: int = 20
    depth: int = 6
    seed: int = 11
    threshold: float = 0.5


_CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}+(?:={1,2}(?![A-Za-z0-9_+/=\"'-]))?")
_BOTH_CASES = re.compile(r"[a-z][A-Z]|[A-Z]{2}[a-z]")
_LETTERS = re.compile(r"[^\W\d_]+")
#: How far to look for words near a candidate.
NEAR = 48

# Names that stand before secrets, words of examples, and the forms of well-known issuers.
_NAMES = r"(?:api[_-]?key|access[_-]?key|secret|token|passw(?:or)?d|passwd|pwd|auth|bearer|credential|private[_-]?key)"
KEY_NAMES = re.compile(_NAMES + r"\W{0,6}$", re.IGNORECASE)
#: A value after such a name: in quotes, or up to a blank or a sign that ends it.
_ASSIGNED = re.compile(
    _NAMES + r"[\"'`]?[ \t]*+(?:[:=]=?|=>)[ \t]*+(?:(?P<quote>[\"'`])(?P<quoted>[^\"'`\s]{4,}+)(?P=quote)|(?P<bare>[^\"'`\s,;&()\[\]{}<>]{4,}+))",
    re.IGNORECASE)
EXAMPLES = re.compile(r"example|sample|dummy|placeholder|changeme|your[_-]|xxxx|fake|test", re.IGNORECASE)
ISSUED = re.compile(
    r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}")
TEST_PATH = re.compile(r"test|example|sample|fixture|mock|demo|doc", re.IGNORECASE)

FEATURES = (
    "length", "digits", "uppers", "lowers", "signs", "distinct", "entropy", "class_changes", "hex_only", "odd_pairs",
    "vowels", "longest_run", "covered", "key_before", "example_near", "assigned", "quoted", "in_address", "words_near",
    "path_depth", "test_path", "issued")
_FREQUENT = frozenset("th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve me de ch ie ei ne un "
                      "ge ma la el os ra ue qu do ci co ar ad ao eu em ai li ri ro".split())


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of candidates, in code points, ends exclusive."""
    found = []
    for m in _CANDIDATE.finditer(text):
        token = m[0]
        if any(c.isdigit() for c in token) and any(c.isalpha() for c in token) or _BOTH_CASES.search(token) or ISSUED.fullmatch(token):
            found.append(m.span())
    for m in _ASSIGNED.finditer(text):
        start, end = m.span("quoted" if m["quote"] else "bare")
        if not m["quote"]:
            end = start + len(text[start:end].rstrip(".:!?"))
        if end - start >= 4:
            found.append((start, end))
    out, free = [], 0
    for start, end in sorted(found, key=lambda s: (s[0], -s[1])):
        if start >= free:
            out.append((start, end))
            free = end
    return out


def _kind(char: str) -> int:
    return 0 if char.isdigit() else 1 if char.isupper() else 2 if char.islower() else 3


def _covered(token: str, words: frozenset[str]) -> float:
    """Share of the characters that a left-to-right search for the longest words covers."""
    text, at, covered = token.lower(), 0, 0
    while at < len(text):
        size = next((k for k in range(min(12, len(text) - at), 2, -1) if text[at: at + k] in words), 0)
        covered += size
        at += size or 1
    return covered / len(token)


def describe(text: str, start: int, end: int, path: str, words: frozenset[str]) -> list[float]:
    """The numbers of ``FEATURES`` for one candidate."""
    token = text[start:end]
    n = len(token)
    before, after = text[max(0, start - NEAR): start], text[end: end + NEAR]
    kinds = [_kind(c) for c in token]
    count: dict[str, int] = {}
    for c in token:
        count[c] = count.get(c, 0) + 1
    pairs = [token[i: i + 2].lower() for i in range(n - 1)]
    run = longest = 1
    for a, b in zip(token, token[1:]):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    return [
        float(n), kinds.count(0) / n, kinds.count(1) / n, kinds.count(2) / n, kinds.count(3) / n, len(count) / n,
        -sum(k / n * math.log2(k / n) for k in count.values()),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / (n - 1),
        float(all(c in "0123456789abcdefABCDEF" for c in token)),
        sum(p not in _FREQUENT for p in pairs) / (n - 1),
        sum(c in "aeiouAEIOU" for c in token) / n, float(longest), _covered(token, words),
        float(bool(KEY_NAMES.search(before))), float(bool(EXAMPLES.search(before) or EXAMPLES.search(token) or EXAMPLES.search(after))),
        float(before.rstrip(" \"'")[-1:] in ("=", ":")), float(before[-1:] in "\"'`" and after[:1] in "\"'`" and bool(before)),
        float(before[-1:] in ("@", ".", "/") or after[:1] in ("@", ".") and after[1:2].isalnum()),
        float(sum(w in words for w in _LETTERS.findall(f"{before} {after}".lower()))),
        float(path.count("/")), float(bool(TEST_PATH.search(path))), float(bool(ISSUED.fullmatch(token)))]


def weak_label(values: list[float]) -> float | None:
    """1 or 0 where the form of a finding settles it, else nothing."""
    v = dict(zip(FEATURES, values, strict=True))
    if v["example_near"] and not v["key_before"] or v["longest_run"] >= 5 or v["in_address"] or v["covered"] > 0.6:
        return 0.0
    if v["issued"] or v["key_before"] and v["entropy"] >= 3 and v["odd_pairs"] > (0.6 if v["digits"] else 0.8):
        return 1.0
    if v["key_before"]:
        return None
    if not v["digits"] or v["distinct"] < 0.2 or v["vowels"] > 0.35 and not v["hex_only"]:
        return 0.0
    return None


def dictionary(docs: DataFrame, config: SecretConfig = SecretConfig()) -> frozenset[str]:
    """Lower-case words of 3 to 12 letters that at least ``word_share`` of all documents hold, and ``word_docs`` of them.

    Letters next to digits or to signs that candidates are made of are no words: no piece of a candidate is counted.
    """
    free = r"(?<![\p{L}\p{N}_+/=-])\p{L}{3,12}(?![\p{L}\p{N}_+/=-])"
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(free), F.lit(0)))).alias("word"))
    counted = words.groupBy("word").count()
    least = max(float(config.word_docs), config.word_share * docs.count())
    rows = counted.where(F.col("count") >= least).select("word").collect()
    return frozenset(r.word for r in rows)


def findings(docs: DataFrame, words: frozenset[str], path: Column | str = "source") -> DataFrame:
    """``doc_id, start, end, sha256, features, weak_label`` of every candidate."""
    sent = docs.sparkSession.sparkContext.broadcast(words)
    column = F.col(path) if isinstance(path, str) else path
    rows = docs.select("doc_id", "text", F.coalesce(column.cast("string"), F.lit("")).alias("path"))

    def run(batches):
        import hashlib

        known = sent.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                found = []
                for doc_id, text, where in zip(*(c.to_pylist() for c in batch.slice(begin, 500).columns), strict=True):
                    for s, e in candidates(text or ""):
                        values = describe(text, s, e, where, known)
                        found.append((doc_id, s, e, hashlib.sha256(text[s:e].encode()).hexdigest(), values, weak_label(values)))
                if found:
                    kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()), pa.float64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)],
                        ["doc_id", "start", "end", "sha256", "features", "weak_label"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, start long, end long, sha256 string, features array<double>, weak_label double")


def _vectors(rows: DataFrame) -> DataFrame:
    spread = rows.select("*", *[F.get("features", F.lit(i)).alias(f"_{name}") for i, name in enumerate(FEATURES)])
    return VectorAssembler(inputCols=[f"_{n}" for n in FEATURES], outputCol="_vector").transform(spread)


def train_forest(labelled: DataFrame, config: SecretConfig = SecretConfig()):
    """A random forest on ``features`` and ``label`` (0 or 1), or None unless there are findings of both kinds.

    Repeated findings count once; at most about ``train_rows`` are taken, drawn by a hash of the finding.
    """
    known = labelled.where(F.col("label").isNotNull()).groupBy("sha256", "features", "label").agg(F.lit(1).alias("n"))
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, min(1.0, config.train_rows / 2 / n)).otherwise(share)
    drawn = known.where(F.pmod(F.xxhash64("sha256", "features"), F.lit(1 << 30)) <= share * (1 << 30))
    forest = RandomForestClassifier(
        featuresCol="_vector", labelCol="label", numTrees=config.trees, maxDepth=config.depth, seed=config.seed)
    return forest.fit(_vectors(drawn.orderBy("sha256", "features")).select("_vector", "label"))


def judge(found: DataFrame, forest, config: SecretConfig = SecretConfig()) -> DataFrame:
    """The findings with ``probability`` and ``is_secret``."""
    if forest is None:
        scored = found.withColumn("probability", F.lit(0.5))
    else:
        scored = forest.transform(_vectors(found)).withColumn("probability", vector_to_array("probability")[1])
    return scored.select(*found.columns, "probability", (F.col("probability") >= config.threshold).alias("is_secret"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, path: Column | str = "source", config: SecretConfig = SecretConfig()) -> DataFrame:
    """``doc_id, start, end, sha256, probability, is_secret`` of every candidate of ``docs``.

    ``labelled``: findings with ``sha256``, ``features`` and ``label``; without it, the weak labels teach.
    """
    found = landed(findings(docs, dictionary(docs, config), path), "secret-findings")
    teach = found.withColumn("label", F.col("weak_label")) if labelled is None else labelled
    forest = train_forest(teach, config)
    return judge(found, forest, config).select("doc_id", "start", "end", "sha256", "probability", "is_secret")
