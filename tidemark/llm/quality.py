"""Quality by weak supervision: rules vote, EM weighs them, a posterior decides.

Each rule looks at one statistic of the whole text and votes good, bad or
abstains. Nothing is rejected because one rule says so: expectation-maximisation
over all documents estimates how each rule votes on good and on bad documents
(a rule's accuracies), and the posterior probability of "good" decides.

The votes of a document form a pattern of ``3 ** len(RULES)`` possible values, so
the corpus enters EM as pattern counts, a table of bounded size that Spark
aggregates over all documents; the posterior of a pattern is looked up.

Defined results: null or empty text has no words and fails the base rules;
an empty table gives an empty result; repeated rows get equal verdicts; columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import IS_SPACE, IS_START, materialize, table

#: Documents shorter than this many words fail the base rules.
MIN_WORDS = 50
#: ... and those with more than this percentage of words inside repeated windows.
MAX_REPEAT_PERCENT = 50
WINDOW = 3
#: Past this many different words, window codes are built in two steps.
MAX_BASE = 2_000_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_LETTER = _UPPER.copy()
_LETTER[ord("a"):ord("z") + 1] = True
_BYTES = np.stack([IS_START & ~IS_SPACE, _SYMBOL, _UPPER, _LETTER]).astype(np.int64)


@dataclass(frozen=True)
class Rule:
    """Votes bad beyond ``bad``, good within ``good``, abstains between and where the statistic is undefined.

    ``statistic`` divides two counts of ``COUNTS``; with ``low`` the bad side is the low side.
    """

    name: str
    part: str
    whole: str
    good: float
    bad: float
    low: bool = False


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_upper", "n_letters", "n_bang", "n_lines", "n_distinct", "n_bare"]

#: A good side that no value reaches: such a rule votes bad or abstains.
NEVER = float("-inf")

RULES = (
    Rule("symbols", "n_symbols", "n_words", 0.05, 0.2),
    Rule("repeats", "n_repeat_words", "n_words", 0.15, 0.35),
    Rule("capitals", "n_upper", "n_letters", 0.12, 0.4),
    Rule("exclamations", "n_bang", "n_words", 0.02, 0.15),
    Rule("symbol_chars", "n_symbols", "word_chars", 0.01, 0.08),
    Rule("bare_symbols", "n_bare", "n_words", NEVER, 0.1),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", NEVER, 0.4),
    Rule("variety", "n_distinct", "n_words", -NEVER, 0.1, low=True),
    Rule("long_words", "word_chars", "n_words", NEVER, 14.0),
)
GOOD, ABSTAIN, BAD = 0, 1, 2


def repeated_words(ids: np.ndarray, n_ids: int) -> int:
    """Words inside a window of three that occurs at least twice in the text."""
    if len(ids) <= WINDOW:
        return 0
    if n_ids <= MAX_BASE:
        code = (ids[:-2] * n_ids + ids[1:-1]) * n_ids + ids[2:]
    else:
        pair, code = np.unique(ids[:-2] * n_ids + ids[1:-1], return_inverse=True)
        code = np.unique(code.astype(np.int64) * n_ids + ids[2:], return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    ordered = code[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(code), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(ids), bool)
    for k in range(WINDOW):
        inside[k:len(code) + k] |= twice
    return int(inside.sum())


def text_counts(text: bytes | None) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one text (UTF-8)."""
    text = text or b""
    words = text.split()
    seen = dict.fromkeys(words)
    number = dict(zip(seen, range(len(seen))))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    word_chars, symbols, upper, letters = (_BYTES @ by_byte).tolist()
    lines = [x for x in text.split(b"\n") if x.strip()]
    bare = int(np.isin(ids, [number[w] for w in (b"|", b"-", b"*", b"#", b"&") if w in number]).sum()) if words else 0
    return (len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated_words(ids, len(seen)),
            upper, letters, int(by_byte[ord("!")]), len(lines), len(seen), bare)


def document_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_counts(t) for t in batch.column(1).to_pylist()]
            found = np.array(rows, np.int64).reshape(len(rows), len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(found[:, k]) for k in range(len(COUNTS)))], names=["doc_id", *COUNTS])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, schema)


def votes(rules: tuple[Rule, ...] = RULES) -> F.Column:
    """The vote pattern of a row of counts: one base-3 digit for each rule."""
    pattern = F.lit(0)
    for rule in rules:
        value = F.col(rule.part) / F.nullif(F.col(rule.whole), F.lit(0))
        good, bad = (value >= rule.good, value <= rule.bad) if rule.low else (value <= rule.good, value >= rule.bad)
        pattern = pattern * 3 + F.when(good, GOOD).when(bad, BAD).otherwise(ABSTAIN)
    return pattern.cast("int")


@dataclass(frozen=True)
class Model:
    """``chance[y, rule, vote]`` for y = 0 (bad), 1 (good), and the share of good documents."""

    chance: np.ndarray
    good_share: float

    def posterior(self, digits: np.ndarray) -> np.ndarray:
        logs = np.log(np.array([1 - self.good_share, self.good_share]))[:, None] + sum(
            np.log(self.chance[:, k, digits[:, k]]) for k in range(digits.shape[1]))
        logs -= logs.max(axis=0)
        p = np.exp(logs)
        return p[1] / p.sum(axis=0)


def digits_of(patterns: np.ndarray, n_rules: int) -> np.ndarray:
    return np.stack([patterns // 3 ** (n_rules - 1 - k) % 3 for k in range(n_rules)], axis=1)


def fit(patterns: np.ndarray, counts: np.ndarray, n_rules: int, rounds: int = 200, smooth: float = 1.0) -> Model:
    """EM over pattern counts. Starts from rules that are better than chance, which names the classes;
    the smoothing counts of the start keep a rule that never fires, and an empty corpus, defined."""
    start = np.empty((2, n_rules, 3))
    start[0], start[1] = (0.5, 0.15, 0.35), (0.9, 0.08, 0.02)
    model = Model(start, 0.85)
    if not len(patterns):
        return model
    digits = digits_of(patterns, n_rules)
    one_hot = np.eye(3)[digits]
    for _ in range(rounds):
        good = model.posterior(digits)
        weight = np.stack([(1 - good) * counts, good * counts])
        votes_ = np.einsum("yp,prv->yrv", weight, one_hot) + smooth * start
        fresh = Model(votes_ / votes_.sum(axis=2, keepdims=True),
                      float((weight[1].sum() + 0.85 * smooth) / (counts.sum() + smooth)))
        moved = max(np.abs(fresh.chance - model.chance).max(), abs(fresh.good_share - model.good_share))
        model = fresh
        if moved < 1e-9:
            break
    return model


def posteriors(counted: DataFrame, rules: tuple[Rule, ...] = RULES) -> np.ndarray:
    """The posterior of every possible vote pattern, by EM over all rows of ``counted`` that pass the base rules.

    Only pattern counts reach the driver: at most ``3 ** len(rules)`` rows.
    """
    tally = counted.filter(~base_failed()).groupBy(votes(rules).alias("pattern")).count().orderBy("pattern").collect()
    model = fit(np.array([r["pattern"] for r in tally], np.int64), np.array([r["count"] for r in tally], float), len(rules))
    return model.posterior(digits_of(np.arange(3 ** len(rules)), len(rules)))


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def quality(docs: DataFrame, threshold: float = 0.5, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: counts, base verdict, posterior and whether it is kept."""
    counted = materialize(document_counts(docs), "quality")
    by_pattern = F.lit([float(x) for x in posteriors(counted, rules)])
    scored = counted.withColumn("base_failed", base_failed()).withColumn(
        "quality", F.get(by_pattern, votes(rules)))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def keep_good(docs: DataFrame, threshold: float = 0.5, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns.

    The texts are read a second time and counted again beside the filter, so they are never shuffled.
    """
    counted = materialize(document_counts(docs), "quality")
    keeps = posteriors(counted, rules) >= threshold

    def verdict(texts: pa.Array) -> pa.Array:
        rows = np.array([text_counts(t) for t in texts.to_pylist()], np.int64).reshape(-1, len(COUNTS))
        return pa.array(accept(rows, keeps, rules))

    kept = F.arrow_udf(verdict, "boolean")
    return docs.filter(kept(F.col("text").cast("binary")))


def accept(rows: np.ndarray, keeps: np.ndarray, rules: tuple[Rule, ...] = RULES) -> np.ndarray:
    """What ``quality`` decides, for rows of counts inside a task."""
    col = {c: rows[:, k].astype(float) for k, c in enumerate(COUNTS)}
    pattern = np.zeros(len(rows), np.int64)
    for rule in rules:
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.where(col[rule.whole] > 0, col[rule.part] / col[rule.whole], np.nan)
        good, bad = (value >= rule.good, value <= rule.bad) if rule.low else (value <= rule.good, value >= rule.bad)
        pattern = pattern * 3 + np.where(good, GOOD, np.where(bad, BAD, ABSTAIN))
    failed = (col["n_words"] < MIN_WORDS) | (100 * col["n_repeat_words"] > MAX_REPEAT_PERCENT * col["n_words"])
    return ~failed & keeps[pattern]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: base counts, base verdict and the posterior's verdict for all documents."""
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
