"""Operator 6: language identification by prediction by partial matching.

For each language the byte contexts of up to ``ORDER`` bytes and the bytes that
follow them are counted. A byte's probability is its share in the longest
context that has seen it, times the escape probability (method C: distinct
followers against all) of every longer context that has been seen but not with
this byte; below order 0 all 256 bytes are alike. The language whose frozen
statistics give the whole text the shortest code wins, ties by name.

The statistics are fitted on a bounded sample of the labelled training rows:
pieces of texts (whole, if they have at most ``PIECE`` bytes) in the order of a
hash, until a language has ``SAMPLE_BYTES`` (all of a language that has less).
Every language with any bytes is learned. So the model is bounded by the number
of languages, whatever the corpus; every text is scored, whole.

Defined cases: a text that is null, empty or has no letter is ``und`` with
score 0; so is every text if no training row has a language. An id may be null
(it counts as the empty text) or repeat; every row is judged for itself. An
empty table gives no rows. Only ``id_col``, ``text_col`` and, in training,
``lang_col`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK, blocks, bounded_batches, by_place, is_training, text_bytes, tidied, worker_state

ORDER = 4
SAMPLE_BYTES = 1_500_000
#: Bytes of a text that are drawn together.
PIECE = 1 << 16
#: A text is in no learned language if the best model codes it longer than its plain bytes by this many bits.
REJECT_BITS = 64.0
#: Bytes of memory for codes of contexts seen before, per worker.
CACHE_BYTES = 16_000_000
UNKNOWN = "und"
_U = np.uint64
_MIX = _U(0x9E3779B97F4A7C15)


def gram_codes(data: np.ndarray, offs: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For each byte, the byte and the ``order`` bytes before it in its text (0 before its start), as one number."""
    wide = data.astype(_U)
    codes = wide.copy()
    starts = offs[:-1]
    for j in range(1, order + 1):
        before = np.zeros(len(data), _U)
        before[j:] = wide[:max(len(data) - j, 0)]
        for t in range(j):
            at = starts + t
            before[at[at < len(data)]] = 0
        codes |= before << _U(8 * j)
    return codes


@dataclass
class LanguageModel:
    """Per order k: known (k + 1)-byte grams with their log2 probabilities and known contexts with their log2
    escapes, one column per language (in code-point order)."""

    languages: list[str]
    order: int = ORDER
    grams: list[np.ndarray] = field(default_factory=list)
    logs: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    escapes: list[np.ndarray] = field(default_factory=list)

    def log2(self, codes: np.ndarray) -> np.ndarray:
        """log2 probabilities of the last byte of each code, one column per language."""
        out = np.zeros((len(codes), len(self.languages)))
        left = np.arange(len(codes))
        for k in range(self.order, -1, -1):
            own = codes[left] & _U((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(self.grams[k], own), len(self.grams[k]) - 1)
            known = self.grams[k][at] == own
            out[left[known]] += self.logs[k][at[known]]
            left, own = left[~known], own[~known]
            if not len(left):
                return out
            context = own >> _U(8)
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            seen = self.contexts[k][at] == context
            out[left[seen]] += self.escapes[k][at[seen]]
        out[left] -= 8.0
        return out


def compile_model(languages: list[str], lang: np.ndarray, code: np.ndarray, count: np.ndarray,
                  order: int = ORDER) -> LanguageModel:
    """The model from counts of the longest grams (language number, code, count)."""
    model, width = LanguageModel(languages, order), len(languages)
    for k in range(order + 1):
        own = code & _U((1 << 8 * (k + 1)) - 1)
        grams, at = np.unique(own, return_inverse=True)
        seen = np.zeros((len(grams), width))
        np.add.at(seen, (at, lang), count)
        contexts, of = np.unique(grams >> _U(8), return_inverse=True)
        total, distinct = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
        np.add.at(total, of, seen)
        np.add.at(distinct, of, seen > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, np.log2(distinct / (total + distinct)), 0.0)
            share = np.log2(seen / (total + distinct)[of])
        if k == 0:
            shorter = np.full((len(grams), width), -8.0)
        else:
            shorter = model.logs[k - 1][np.searchsorted(model.grams[k - 1], grams & _U((1 << 8 * k) - 1))]
        model.grams.append(grams)
        model.logs.append(np.where(seen > 0, share, escape[of] + shorter))
        model.contexts.append(contexts)
        model.escapes.append(escape)
    return model


def train(docs: DataFrame, training=None, sample_bytes: int = SAMPLE_BYTES, order: int = ORDER,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fits the model on rows with a language (and ``training`` true, if given)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    usable = F.col(lang_col).isNotNull() & (F.octet_length(F.col(text_col).cast("string")) > 0)
    rows = docs.filter(usable if training is None else usable & training).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text")) \
        .select("lang", "text", F.xxhash64("id", "text").alias("key"), F.octet_length("text").alias("size"))
    numbers = f"sequence(0, cast((size - 1) div {PIECE} as int))"
    # eight steps for each doubling of the hash: the last step taken is small beside all before it
    step = f"cast(floor(8 * log2(xxhash64(key, piece) % {1 << 30} + {1 << 30})) as int)"
    sizes: dict[str, dict[int, int]] = {}
    for r in rows.select("lang", "key", "size").withColumn("piece", F.explode(F.expr(numbers))) \
            .groupBy("lang", F.expr(step).alias("step")) \
            .agg(F.sum(F.expr(f"least({PIECE}, size - piece * {PIECE}L)")).alias("bytes")).collect():  # 249 rows a language
        sizes.setdefault(r["lang"], {})[r["step"]] = r["bytes"]
    languages = sorted(sizes, key=lambda x: x.encode())
    if not languages:
        return LanguageModel([], order)
    number = {x: i for i, x in enumerate(languages)}
    lasts = []
    for x in languages:
        total = 0
        for last in sorted(sizes[x]):
            total += sizes[x][last]
            if total >= sample_bytes:
                break
        lasts.append((x, last))
    lasts = spark.createDataFrame(lasts, "name string, last int")
    sample = rows.join(F.broadcast(lasts), F.col("lang") == F.col("name")) \
        .withColumn("pieces", F.expr(f"filter({numbers}, piece -> {step} <= last)")) \
        .filter(F.size("pieces") > 0).select("lang", "text", "pieces")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            of = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            drawn = batch.column(2)
            row = np.repeat(np.arange(batch.num_rows), np.diff(drawn.offsets.to_numpy()))
            start = offs[row] + drawn.flatten().to_numpy().astype(np.int64) * PIECE
            end = np.minimum(start + PIECE, offs[row + 1])
            lead = np.minimum(start - offs[row], order)  # the bytes before a piece are its first contexts
            for i, j, _, o in blocks(data, np.concatenate([[0], np.cumsum(end - start + lead)])):
                d = np.concatenate([data[a:b] for a, b in zip(start[i:j] - lead[i:j], end[i:j], strict=True)])
                codes = gram_codes(d, o, order)
                codes |= np.repeat(of[row[i:j]], np.diff(o)).astype(_U) << _U(8 * (order + 1))
                own = np.arange(len(d)) - np.repeat(o[:-1], np.diff(o)) >= np.repeat(lead[i:j], np.diff(o))
                found, n = np.unique(codes[own], return_counts=True)
                yield pa.record_batch([pa.array(found.astype(np.int64)), pa.array(n)], ["code", "n"])

    counts = sample.mapInArrow(tidied(count), "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    codes = counts.column("code").to_numpy().astype(_U)
    learned, lang = np.unique((codes >> _U(8 * (order + 1))).astype(np.int64), return_inverse=True)
    return compile_model([languages[i] for i in learned], lang, codes & _U((1 << 8 * (order + 1)) - 1),
                         counts.column("n").to_numpy(), order)


class _Coder:
    """Code lengths of whole texts, with the codes of grams seen before kept in a table of a fixed size."""

    def __init__(self, model: LanguageModel):
        self.model, width = model, len(model.languages)
        self.bits = max(10, min(20, int(np.log2(CACHE_BYTES / (8 + 4 * width)))))
        self.keys = np.zeros(1 << self.bits, _U)
        self.rows = np.zeros((1 << self.bits, width), np.float32)

    def logs(self, codes: np.ndarray) -> np.ndarray:
        h = codes * _MIX
        slot = (h >> _U(64 - self.bits)).astype(np.int64)
        missed = np.flatnonzero(self.keys[slot] != codes)
        out = self.rows[slot]
        if len(missed):
            new, at, back = np.unique(codes[missed], return_index=True, return_inverse=True)
            rows = self.model.log2(new).astype(np.float32)
            out[missed] = rows[back]
            place = slot[missed[at]]
            self.rows[place], self.keys[place] = rows, new
            # of two grams in one slot the later won in both arrays
        return out

    def bits_of(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Code length in bits of each text, one column per language."""
        out = np.zeros((len(offs) - 1, len(self.model.languages)))
        order = self.model.order
        for i, j, d, o in blocks(data, offs):
            if len(d) <= 2 * BLOCK:
                parts = [(self.logs(gram_codes(d, o, order)), o)] if len(d) else []
            else:  # one very long text, block by block, each with the bytes before it
                parts = []
                for a in range(0, len(d), BLOCK):
                    lead = min(a, order)
                    piece = d[a - lead:a + BLOCK]
                    logs = self.logs(gram_codes(piece, np.array([0, len(piece)]), order)[lead:])
                    out[i] -= logs.sum(axis=0, dtype=np.float64)
            for logs, o in parts:
                full = np.flatnonzero(np.diff(o))
                out[i + full] -= np.add.reduceat(logs.astype(np.float64), o[full], axis=0)
        return out


def _has_letter(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    letter = np.zeros(256, bool)
    letter[[*range(65, 91), *range(97, 123)]] = True
    total = np.concatenate([[0], np.cumsum(letter[data])])
    out = total[offs[1:]] > total[offs[:-1]]
    for k in np.flatnonzero(~out & (np.diff(offs) > 0)):
        out[k] = any(c.isalpha() for c in data[offs[k]:offs[k + 1]].tobytes().decode())
    return out


def judge(column: pa.Array, model: LanguageModel) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score (posterior with equal priors), code length and bytes of each text of an Arrow column."""
    data, offs = text_bytes(column)
    n = np.diff(offs)
    if not model.languages:
        return [UNKNOWN] * len(n), np.zeros(len(n)), np.full(len(n), np.inf), n
    held = worker_state("language_coder", dict)  # one model at a time
    if held.get("model") is not model:
        held.update(model=model, coder=_Coder(model))
    bits = held["coder"].bits_of(data, offs)
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(n)), best]
    score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
    letters = _has_letter(data, offs)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist(), strict=True)]
    return names, np.where(letters, score, 0.0), np.where(letters, least, np.inf), n


def _shipped(docs: DataFrame, model: LanguageModel):
    spark = docs.sparkSession
    bounded_batches(spark)
    return spark.sparkContext.broadcast(model)  # bounded by the number of languages and SAMPLE_BYTES


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_byte) of every row."""
    shipped = _shipped(docs, model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score, bits, n = judge(batch.column(1), shipped.value)
            rate = bits / np.maximum(n, 1)
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(score),
                                   pa.array(rate, mask=~np.isfinite(rate))],
                                  ["doc_id", "lang_pred", "score", "bits_per_byte"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(predict), "doc_id bigint, lang_pred string, score double, bits_per_byte double")


def keep_identified(docs: DataFrame, model: LanguageModel, reject_bits: float = REJECT_BITS,
                    text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language: not ``und``, and not coded by the best model with
    ``reject_bits`` bits more than its plain bytes have. Same columns; a null language becomes the predicted one."""
    shipped = _shipped(docs, model)
    at, lang, rows = docs.columns.index(text_col), docs.columns.index(lang_col), by_place(docs)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, _, bits, n = judge(batch.column(at), shipped.value)
            fits = (bits - 8 * n < reject_bits) & (np.array(names, object) != UNKNOWN)
            column = batch.column(lang)
            if column.null_count:
                column = pa.compute.coalesce(column, pa.array(names, column.type))
                batch = batch.set_column(lang, batch.schema.field(lang), column)
            yield batch.filter(pa.array(fits.astype(bool)))

    return rows.mapInArrow(tidied(select), rows.schema).toDF(*docs.columns)


def op6_language_ppm(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, is_training("doc_id", 3, 1))
    return identify(docs, model).withColumn("held_out", ~is_training("doc_id", 3, 1)) \
        .select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")
