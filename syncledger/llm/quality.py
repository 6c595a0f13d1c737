"""Operator 7: quality by weak supervision.

Rules vote good, bad or abstain on each document's statistics. Votes are
counted per vote pattern over the whole corpus (at most 3 ** rules patterns),
expectation-maximisation on those counts estimates each rule's accuracies and
the share of good documents, and a document is kept on its posterior
probability of being good, not on passing every rule.

Defined cases: a null or empty text has no words, all statistics 0, and fails
the base rule (n_words < 20); an id may be null or repeat, every row is judged
for itself; an empty table gives no rows. Only ``id_col`` and ``text_col`` are
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    blocks,
    bounded_batches,
    space_table,
    span_hashes,
    stored,
    text_bytes,
    tidied,
    window_hashes,
    word_hashes,
)

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Rules: name, the statistic as SQL, a good vote at or beyond the first limit, a bad one at or beyond the second;
#: between them the rule abstains. Ratios of a document with no words are null: the rule abstains.
RULES = (
    ("words", "n_words", 50, 20),
    ("symbols", "-n_symbols / n_words", -0.02, -0.10),
    ("symbol_characters", "-n_symbols / word_chars", -0.005, -0.03),
    ("repeated_lines", "-n_dup_lines / n_lines", -0.05, -0.30),
    ("repeated_words", "-n_repeat_words / n_words", -0.05, -0.20),
    ("letters", "n_letters / word_chars", 0.75, 0.60),
    ("capitals", "-n_capitals / n_letters", -0.20, -0.50),
    ("distinct_words", "n_distinct / sqrt(n_words)", 2.5, 1.5),
    ("sentence_ends", "n_stops / n_lines", 0.5, 0.05),
    ("word_length", "-abs(word_chars / n_words - 5.5)", -2.0, -4.5),
)
ROUNDS = 50
#: At the start a bad vote outweighs so many good ones: rules call bad only what is far out, and good what is usual.
BAD_WEIGHT = 5

_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_capitals",
          "n_distinct", "n_stops")


def _sums(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offs[1:]] - total[offs[:-1]]


def _lines(data: np.ndarray, offs: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those equal to an earlier line, of each text of a block."""
    n = len(offs) - 1
    if not len(data):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offs[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = np.where(data[ends - 1] == 0x0A, ends - 1, ends)
    words = np.concatenate([[0], np.cumsum(~space[data])])
    worded = words[ends] > words[starts]
    starts, ends = starts[worded], ends[worded]
    doc = np.searchsorted(offs, starts, "right") - 1
    h = span_hashes(data, starts, ends)
    order = np.lexsort((h, doc))
    same = np.zeros(len(h), bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return np.bincount(doc, minlength=n), np.bincount(doc[order][same], minlength=n)


def _repeats(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words inside windows found twice or more, and distinct words, of each text of a block."""
    n = len(first) - 1
    repeated, distinct = np.zeros(n, np.int64), np.zeros(n, np.int64)
    w, at = window_hashes(h, first, WINDOW, short=False)
    for k in range(n):
        words = h[first[k]:first[k + 1]]
        if not len(words):
            continue
        ordered = np.sort(words)
        distinct[k] = 1 + np.count_nonzero(ordered[1:] != ordered[:-1])
        own = w[at[k]:at[k + 1]]
        if len(own) < 2 or distinct[k] == len(words):
            continue
        order = np.argsort(own, kind="stable")
        equal = own[order][1:] == own[order][:-1]
        if not equal.any():
            continue
        twice = np.zeros(len(own), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        edge = np.zeros(len(words) + 1, np.int64)
        hit = np.flatnonzero(twice)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + WINDOW, -1)
        repeated[k] = np.count_nonzero(np.cumsum(edge)[:-1])
    return repeated, distinct


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts that the base and the rules use) of every row, from whole texts."""
    bounded_batches(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = space_table()
        symbol = np.zeros(256, bool)
        symbol[list(SYMBOLS.encode())] = True
        lead = np.ones(256, bool)
        lead[0x80:0xC0] = False
        letter = np.zeros(256, bool)
        letter[[*range(65, 91), *range(97, 123), *range(0xC2, 0xF5)]] = True  # lead bytes count as letters
        capital = np.zeros(256, bool)
        capital[65:91] = True
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            out = {c: np.zeros(batch.num_rows, np.int64) for c in _STATS}
            for i, j, d, o in blocks(data, offs):
                h, first = word_hashes(d, o)
                wide = space[d]
                out["n_words"][i:j] = np.diff(first)
                out["word_chars"][i:j] = _sums(lead[d] & ~wide, o)
                out["n_symbols"][i:j] = _sums(symbol[d], o)
                out["n_letters"][i:j] = _sums(letter[d], o)
                out["n_capitals"][i:j] = _sums(capital[d], o)
                stop = (d == ord(".")) | (d == ord("!")) | (d == ord("?"))
                stop[:-1] &= wide[1:] | (d[1:] == ord("."))
                out["n_stops"][i:j] = _sums(stop, o)
                out["n_lines"][i:j], out["n_dup_lines"][i:j] = _lines(d, o, space)
                out["n_repeat_words"][i:j], out["n_distinct"][i:j] = _repeats(h, first)
            yield pa.record_batch([batch.column(0), *[pa.array(v) for v in out.values()]], ["doc_id", *_STATS])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(measure), "doc_id bigint, " + ", ".join(f"{c} bigint" for c in _STATS))


def votes(rules=RULES):
    """One digit per rule: 2 good, 0 bad, 1 abstain."""
    out = []
    for _, value, good, bad in rules:
        x = F.expr(f"try_divide({value.split(' / ')[0]}, {value.split(' / ')[1]})") if " / " in value and "(" not in value \
            else F.expr(value) if "/" not in value else F.when(F.col("n_words") > 0, F.expr(value))
        out.append(F.when(x >= good, "2").when(x <= bad, "0").otherwise("1"))
    return F.concat(*out)


def estimate(patterns: list[str], counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, dict]:
    """Posterior probability of good for each vote pattern, by expectation-maximisation.

    A rule votes with its own probabilities given good and given bad; rules are
    independent given the class. It starts from the majority of the votes, a bad
    one counting BAD_WEIGHT times.
    """
    v = np.array([[int(c) for c in p] for p in patterns]).reshape(len(patterns), -1)
    onehot = (v[:, :, None] == np.arange(3)).astype(float)
    lean = (v == 2).sum(axis=1) - BAD_WEIGHT * (v == 0).sum(axis=1)
    good = 1 / (1 + np.exp(-np.clip(lean, -30, 30)))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        # each rule is taken to be better than chance: a little of the start stays as a prior
        prior = np.array([[2.0, 1.0, 0.5], [0.5, 1.0, 2.0]])[:, None, :]
        given = np.einsum("cp,prk->crk", weight, onehot) + prior
        given /= given.sum(axis=2, keepdims=True)
        share = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
        log = np.log(share)[:, None] + np.einsum("prk,crk->cp", onehot, np.log(given))
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -60, 60)))
    return good, {"share_good": float(share[1]), "given_bad": given[0], "given_good": given[1]}


def quality(docs: DataFrame, rules=RULES, threshold: float = 0.5, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Statistics, base_failed, the posterior and the verdict of every row."""
    spark = docs.sparkSession
    stats = stored(document_statistics(docs, id_col, text_col).withColumn("pattern", votes(rules)), "quality")
    # at most 3 ** rules rows, whatever the corpus
    seen = sorted((r["pattern"], r["count"]) for r in stats.groupBy("pattern").count().collect())
    patterns = [p for p, _ in seen]
    good, _ = estimate(patterns, np.array([float(n) for _, n in seen])) if seen else (np.zeros(0), {})
    verdicts = spark.createDataFrame([(p, float(g)) for p, g in zip(patterns, good, strict=True)],
                                     "pattern string, p_good double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return stats.join(F.broadcast(verdicts), "pattern").withColumn("base_failed", failed) \
        .withColumn("kept", ~failed & (F.col("p_good") >= threshold))


def op7_quality_weak_supervision(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all ``documents``."""
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "p_good")
