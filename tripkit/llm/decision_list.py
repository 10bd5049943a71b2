"""Quality rules learned as a decision list.

Sequential covering: grow a conjunction of threshold tests on two thirds of the
labelled statistics by information gain, prune its tail on the other third,
accept it while it is precise there, remove what it covers, repeat. The result
is an ordered list of conditions, rendered as one Spark ``CASE`` expression.

Defined results: a null text has no words; empty and short texts fail the base
rule; repeated rows are judged alike, each on its own; rows with a null id are
judged too but never serve as training rows. No labels (or labels of one
class) give an empty list, which keeps all that pass the base rule. Columns of
the input pass through ``filter_documents`` untouched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkit.llm.common import SPACES, free_name, table

#: Labelled rows used to fit the list: the bound on what reaches the driver.
MAX_LABELLED = 50_000
SYMBOLS = b"#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_lines", "n_upper", "n_digits", "n_marks"]
_UPPER, _DIGITS, _MARKS = bytes(range(65, 91)), b"0123456789", b"!?;:/\\=_~^@{}[]()"
STATS_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in STATS])

#: Ratios the rules may test, as SQL over the statistics.
FEATURES = {
    "words": "cast({s}.n_words as double)",
    "word_length": "{s}.word_chars / {s}.n_words",
    "symbol_share": "{s}.n_symbols / {s}.word_chars",
    "upper_share": "{s}.n_upper / {s}.word_chars",
    "digit_share": "{s}.n_digits / {s}.word_chars",
    "mark_share": "{s}.n_marks / {s}.word_chars",
    "dup_line_share": "{s}.n_dup_lines / {s}.n_lines",
    "repeat_share": "{s}.n_repeat_words / {s}.n_words",
    "words_per_line": "{s}.n_words / {s}.n_lines",
}


def _repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    x = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    m = len(ids)
    pair = x[:-2] * m + x[1:-1]
    if m > 2_000_000:  # m**3 would not fit: number the pairs first
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair * m + x[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k:k + len(key)] |= twice
    return int(hit.sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The values of ``STATS`` for one whole text."""
    if not text:
        return (0,) * len(STATS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()

    def count(chars: bytes) -> int:
        return len(raw) - len(raw.translate(None, chars))

    seen: set[bytes] = set()
    lines = dup = 0
    for line in raw.split(b"\n"):
        if line.strip(SPACES):
            lines += 1
            dup += line in seen
            seen.add(line)
    return (len(words), len(text) - count(SPACES), count(SYMBOLS), dup, _repeated_words(words),
            lines, count(_UPPER), count(_DIGITS), count(_MARKS))


def with_stats(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the struct column ``name`` of statistics, one pass, no shuffle."""
    at = docs.columns.index("text")

    def run(batches):
        kinds = [pa.field(c, pa.int64()) for c in STATS]
        for batch in batches:
            rows = [text_stats(v.as_py()) for v in batch.column(at)]
            cols = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * len(STATS)
            stats = pa.StructArray.from_arrays(cols, fields=kinds)
            yield pa.RecordBatch.from_arrays([*batch.columns, stats], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, STATS_TYPE)]))


def features(stats: str) -> list[Column]:
    """Feature columns over the struct column ``stats``; a division by zero gives 0."""
    return [F.coalesce(F.expr(f"try_divide({a.strip()}, {b.strip()})") if b else F.expr(a.strip()), F.lit(0.0)).alias(k)
            for k, (a, _, b) in ((k, v.format(s=stats).partition(" / ")) for k, v in FEATURES.items())]


@dataclass(frozen=True)
class Rule:
    """Reject when every (feature, '<=' or '>', threshold) holds."""
    tests: tuple[tuple[str, str, float], ...]


def _covered(x: np.ndarray, tests) -> np.ndarray:
    ok = np.ones(len(x), bool)
    for j, up, t in tests:
        ok &= (x[:, j] > t) if up else (x[:, j] <= t)
    return ok


def _best_test(x: np.ndarray, y: np.ndarray):
    """The threshold test with the largest FOIL gain on rows x, positives y."""
    p, n = y.sum(), len(y) - y.sum()
    base, best = np.log2(p / (p + n)), (0.0, None)
    for j in range(x.shape[1]):
        order = np.argsort(x[:, j], kind="stable")
        v, cp = x[order, j], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        for up in (False, True):
            pos = (p - cp[cut]) if up else cp[cut]
            all_ = (len(v) - 1 - cut) if up else cut + 1
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(pos > 0, pos * (np.log2(pos / all_) - base), 0.0)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), (j, up, float((v[cut[k]] + v[cut[k] + 1]) / 2)))
    return best[1]


def learn(x: np.ndarray, bad: np.ndarray, min_precision: float = 0.9, max_rules: int = 32,
          seed: int = 7) -> list[Rule]:
    """Sequential covering over labelled statistics; ``bad`` marks rows to reject."""
    names, rules = list(FEATURES), []
    part = np.random.default_rng(seed).random(len(x))
    left = np.ones(len(x), bool)
    while len(rules) < max_rules:
        grow, check = left & (part < 2 / 3), left & (part >= 2 / 3)
        if not bad[grow].any() or not bad[check].any():
            break
        tests, rows = [], grow.copy()
        while (~bad[rows]).any() and len(tests) < 6 and (t := _best_test(x[rows], bad[rows])):
            tests.append(t)
            rows = grow & _covered(x, tests)

        def worth(k: int) -> float:
            hit = check & _covered(x, tests[:k])
            return (bad[hit].sum() - (~bad[hit]).sum()) / max(1, hit.sum())

        if not tests:
            break
        keep = max(range(1, len(tests) + 1), key=lambda k: (worth(k), -k))
        tests = tests[:keep]
        hit = check & _covered(x, tests)
        if not hit.any() or bad[hit].mean() < min_precision:
            break
        rules.append(Rule(tuple((names[j], ">" if up else "<=", t) for j, up, t in tests)))
        left &= ~_covered(x, tests)
    return rules


def rule_column(rules: list[Rule], stats: str) -> Column:
    """1-based number of the first rule that fires, 0 if none: one ordered CASE."""
    value = dict(zip(FEATURES, features(stats)))
    out = None
    for i, rule in enumerate(rules, 1):
        cond = F.lit(True)
        for name, op, t in rule.tests:
            cond = cond & (value[name] > t if op == ">" else value[name] <= t)
        out = F.when(cond, i) if out is None else out.when(cond, i)
    return F.lit(0) if out is None else out.otherwise(0)


def base_failed(stats: str) -> Column:
    s = F.col(stats)
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Learn the list from at most ``max_labelled`` labelled rows (smallest id hashes)."""
    few = (labels.select("doc_id", "quality").dropna().dropDuplicates(["doc_id"])
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    rows = with_stats(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id"), "q")
    got = rows.where(~base_failed("q")).groupBy("doc_id").agg(
        F.first("quality").alias("quality"), F.first("q").alias("q")).select("doc_id", "quality", *features("q")).toPandas()
    got = got.sort_values("doc_id")
    return learn(got[list(FEATURES)].to_numpy(float), got["quality"].to_numpy() == 0) if len(got) else []


def judge(docs: DataFrame, rules: list[Rule], name: str = "quality_stats") -> DataFrame:
    """``docs`` plus its statistics, ``base_failed``, ``rule`` (first that fires, 0: none) and ``kept``."""
    return (with_stats(docs, name).withColumn("base_failed", base_failed(name))
            .withColumn("rule", rule_column(rules, name))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))


def filter_documents(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that the base rule and the list keep, all columns as they were."""
    name = free_name(docs, "quality_stats")
    return (with_stats(docs, name).where(~base_failed(name) & (rule_column(rules, name) == 0))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op8_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fit(docs, table(spark, sf_dir, "labels"))
    return judge(docs, rules, "q").select("doc_id", *[f"q.{c}" for c in STATS[:5]], "base_failed", "kept", "rule")
