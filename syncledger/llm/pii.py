"""Operator 4: personal data by a semi-Markov conditional random field.

Base rules find e-mail addresses, IP addresses, card numbers and phone numbers
by their patterns. The model adds spans that the patterns miss (a phone number
without its plus, an address written with ``[at]``): around every digit or sign
that no base span covers, a semi-Markov CRF scores candidate segments of up to
``MAX_TOKENS`` tokens as a whole (digits and their groups, checksum, octets,
separators, letters, what stands beside them), and dynamic programming over
segments chooses boundaries and kinds together. A chosen segment is added if
its marginal probability is at least ``CONFIDENCE``. Base spans always stay.

The weights are fitted to snippets of the corpus labelled by the base rules,
and to variants of them written in other ways, on a sample of at most
``SNIPPETS`` snippets (those with the smallest hashes, by kind). Searching covers
every whole text.

Defined cases: a null or empty text has no spans; an id may be null or repeat,
every row is searched for itself; without training snippets nothing is added;
an empty table gives no rows. Only ``id_col`` and ``text_col`` are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, by_place, stored, text_bytes, tidied

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 24
#: Characters around a digit or sign that a region takes, and as many more as it takes to reach white space.
WINDOW, REACH = 48, 320
SNIPPETS = 800
EPOCHS = 6
CONFIDENCE = 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_AT = re.compile(r"[\[(] ?at ?[\])]", re.I)
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)
_JOINS = frozenset("@._%+-()[]/")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base rules, by start, then kind in the order of ``KINDS``. Linear in the text."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            done = m.end()
            out.append((start, done, 0))
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(_octet(p) for p in m[0].split(".")):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 40:
            digits = "".join(_DIGITS.findall(m[0]))
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15:
                out.append((m.start(), m.end(), 3))
    return [(s, e, KINDS[k]) for s, e, k in sorted(out, key=lambda x: (x[0], x[2]))]


# ------------------------------------------------------------------ segments

def _side(text: str, at: int) -> str:
    if not 0 <= at < len(text):
        return "edge"
    c = text[at]
    return "digit" if c.isdigit() else "letter" if c.isalpha() else "space" if c.isspace() else c


def segment_features(text: str, start: int, end: int) -> list[str]:
    """Features of the whole span text[start:end] and of what stands beside it."""
    s = text[start:end]
    groups = _DIGITS.findall(s)
    n = sum(map(len, groups))
    letters = sum(c.isalpha() for c in s)
    skeleton = re.sub(r"[^\W\d_]+", "a", _DIGITS.sub("9", s))
    parts = re.split(r"\[?\.\]?", s)
    return ["bias", f"digits{min(n, 20)}", f"groups{'-'.join(str(len(g)) for g in groups[:7])}",
            f"dots{min(s.count('.'), 5)}", f"at{'@' in s or bool(_AT.search(s))}", f"plus{s[0] == '+'}",
            f"round{'(' in s}", f"square{'[' in s}", f"blanks{min(s.count(' '), 5)}", f"dashes{min(s.count('-'), 5)}",
            f"slashes{min(s.count('/'), 3)}", f"letters{min(letters, 3)}", f"luhn{12 <= n <= 19 and luhn(''.join(groups))}",
            f"octets{len(parts) == 4 and all(p.isdecimal() and p.isascii() and _octet(p) for p in parts)}",
            f"left-{_side(text, start - 1)}", f"right-{_side(text, end)}", f"first-{_side(s, 0)}",
            f"last-{_side(s, len(s) - 1)}", f"skeleton-{skeleton[:40]}"]


def candidates(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Token ranges that may be entities: at most MAX_TOKENS, cut at the ends of words, with a digit or an at sign."""
    out = []
    words = [text[a:b] for a, b in tokens]
    n = len(tokens)
    for i in range(n):
        first, a = words[i], tokens[i][0]
        if not (first[0].isalnum() or first in "+("):
            continue
        if first[0].isalnum() and a and text[a - 1].isalnum():
            continue
        seen, j = False, i
        while j < n and j - i < MAX_TOKENS:
            w = words[j]
            if w.isspace():  # a single blank, beside a word only if its other side is a bracket
                near = [words[k] for k in (j - 1, j + 1) if i <= k < n]
                word = any(x[0].isalpha() for x in near) and not any(x in "[]()" for x in near)
                if w != " " or word or any(x.isspace() for x in near):
                    break
            elif not w[0].isalnum() and w not in _JOINS:
                break
            seen |= w[0].isdigit() or w == "@" or w.lower() == "at"
            b = tokens[j][1]
            ends = w[0].isalnum() or w == ")"
            if seen and ends and not (w[0].isalnum() and b < len(text) and text[b].isalnum()):
                out.append((i, j + 1))
            j += 1
    return out


class SegmentModel:
    """Weights of segment features, one column per kind."""

    def __init__(self, features: dict[str, int], weights: np.ndarray):
        self.features, self.weights = features, weights

    def scores(self, text: str, tokens: list[tuple[int, int]], spans: list[tuple[int, int]]) -> np.ndarray:
        out = np.zeros((len(spans), len(KINDS)))
        for k, (i, j) in enumerate(spans):
            ids = [self.features[f] for f in segment_features(text, tokens[i][0], tokens[j - 1][1])
                   if f in self.features]
            out[k] = self.weights[ids].sum(axis=0)
        return out


def _forward(n: int, spans: list[tuple[int, int]], scores: np.ndarray) -> np.ndarray:
    """log sums over all segmentations of the first t tokens; a token outside any entity scores 0."""
    total = np.logaddexp.reduce(scores, axis=1) if len(spans) else []
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (_, j) in enumerate(spans):
        ending[j].append(k)
    alpha = np.zeros(n + 1)
    for t in range(1, n + 1):
        alpha[t] = np.logaddexp.reduce([alpha[t - 1], *(alpha[spans[k][0]] + total[k] for k in ending[t])]) \
            if ending[t] else alpha[t - 1]
    return alpha


def marginals(n: int, spans: list[tuple[int, int]], scores: np.ndarray) -> np.ndarray:
    """Probability of each segment with each kind."""
    alpha = _forward(n, spans, scores)
    beta = _forward(n, [(n - j, n - i) for i, j in spans], scores)[::-1]
    outer = np.array([alpha[i] + beta[j] for i, j in spans])
    return np.exp(outer[:, None] + scores - alpha[n])


def best_segments(n: int, spans: list[tuple[int, int]], scores: np.ndarray) -> list[int]:
    """The segments of the best segmentation (each with its best kind), by Viterbi over bounded segments."""
    top = scores.max(axis=1) if len(spans) else []
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (_, j) in enumerate(spans):
        ending[j].append(k)
    best, back = [0.0] * (n + 1), [-1] * (n + 1)
    for t in range(1, n + 1):
        best[t] = best[t - 1]
        for k in ending[t]:
            value = best[spans[k][0]] + top[k]
            if value > best[t]:
                best[t], back[t] = value, k
    out, t = [], n
    while t > 0:
        k = back[t]
        if k < 0:
            t -= 1
        else:
            out.append(k)
            t = spans[k][0]
    return out[::-1]


def _regions(text: str, covered: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Stretches of text around the digits and signs that no base span covers, between base spans and line ends."""
    walls, end = [], 0
    for s, e, _ in covered:  # by start
        if e > end:
            walls.append((max(s, end), e))
            end = e
    free, at = [], 0
    for s, e in [*walls, (len(text), len(text))]:
        if s > at:
            free.append((at, s))
        at = e
    out: list[tuple[int, int]] = []
    trigger = re.compile(r"[0-9]+|@|" + _AT.pattern, re.I)
    for a, b in free:
        for m in trigger.finditer(text, a, b):
            lo, hi = _whole_words(text, max(a, m.start() - WINDOW), min(b, m.end() + WINDOW), a, b)
            lo = max(lo, text.rfind("\n", lo, m.start()) + 1)
            cut = text.find("\n", m.end(), hi)
            hi = cut if cut >= 0 else hi
            if out and lo <= out[-1][1] and out[-1][0] >= a:
                out[-1] = (out[-1][0], max(hi, out[-1][1]))
            else:
                out.append((lo, hi))
    return out


def _whole_words(text: str, lo: int, hi: int, a: int, b: int) -> tuple[int, int]:
    """The stretch from lo to hi, made longer within a and b until it begins and ends at white space."""
    least, most = max(a, lo - REACH), min(b, hi + REACH)
    while lo > least and not text[lo - 1].isspace():
        lo -= 1
    while hi < most and not text[hi].isspace():
        hi += 1
    return lo, hi


def added_spans(text: str, base: list[tuple[int, int, str]], model: SegmentModel) -> list[tuple[int, int, str]]:
    out = []
    for lo, hi in _regions(text, base):
        tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, lo, hi)]
        spans = candidates(text, tokens)
        if not spans:
            continue
        scores = model.scores(text, tokens, spans)
        chosen = best_segments(len(tokens), spans, scores)
        if not chosen:
            continue
        sure = marginals(len(tokens), spans, scores)
        for k in chosen:
            kind = int(scores[k].argmax())
            if sure[k, kind] >= CONFIDENCE:
                out.append((tokens[spans[k][0]][0], tokens[spans[k][1] - 1][1], KINDS[kind]))
    return out


# ------------------------------------------------------------------ training

def _variants(text: str, gold: list[tuple[int, int, str]], seed: int) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """The snippet with its first span written in other ways, of the same kind or of none."""
    if not gold:
        return []
    (s, e, kind), span = gold[0], text[gold[0][0]:gold[0][1]]
    out: list[tuple[str, str | None]] = []
    digits = "".join(_DIGITS.findall(span))
    if kind == "phone" and len(digits) >= 10:
        d = digits[-10:]
        out += [(f"({d[:3]}) {d[3:6]}-{d[6:]}", kind), (f"{d[:3]}-{d[3:6]}-{d[6:]}", kind),
                (f"{d[:3]}.{d[3:6]}.{d[6:]}", kind), (f"{d[:3]} {d[3:6]} {d[6:]}", kind),
                (f"{d[:4]}-{d[4:6]}-{d[6:8]}", None), (d, None), (f"{d[:2]}:{d[2:4]}:{d[4:6]}", None),
                (f"{d[:3]},{d[3:6]},{d[6:9]}", None), (f"{d[0]}.{d[1:3]}.{d[3]}", None), (d[:4], None),
                (f"{d[:2]}/{d[2:4]}/{d[4:8]}", None), (f"{d[:2]}.{d[2:4]}.{d[4:8]}", None), (f"{d[:4]}-{d[4:8]}", None),
                (f"{d[:3]}-{d[3:7]}", None), (f"{d[:1]}.{d[1:2]}", None)]
    elif kind == "email":
        user, _, host = span.partition("@")
        plain, site = re.sub("[^A-Za-z]", "", user) or "x", re.sub("[0-9]", "", host)
        out += [(f"{plain}[at]{site}", kind), (f"{plain} [at] {site}", kind), (f"{plain}(at){site}", kind),
                (f"{plain} (at) {site}", kind), (f"{plain} at {site}", None), (site, None), (f"{plain}.{plain}", None)]
        out += [(f"{user}[at]{host}", kind), (f"{user} [at] {host}", kind), (f"{user}(at){host}", kind),
                (f"{user} (at) {host}", kind), (host, None), (user, None), (f"{user}@", None),
                (f"@{user.split('.')[0]}", None), (hashlib.md5(span.encode()).hexdigest(), None)]
    elif kind == "ip":
        p = span.split(".")
        out += [("[.]".join(p), kind), (f"{p[0]}.{p[1]}", None), (".".join(p[:3]), None),
                (f"{int(p[0][-3:]) + 300}.{'.'.join(p[1:])}", None), (f"{p[0]}.{p[1]}.{p[2]}-{p[3]}", None)]
    elif kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + seed % 8) % 10)
        four = [digits[k:k + 4] for k in range(0, len(digits), 4)]
        out += [(".".join(four), kind), ("/".join(four), kind), (wrong, None),
                (" ".join(wrong[k:k + 4] for k in range(0, len(wrong), 4)), None), (digits[:13], None)]
    made = []
    for new, label in out:
        whole = text[:s] + new + text[e:]
        moved = [(a + len(new) - (e - s), b + len(new) - (e - s), k) for a, b, k in gold[1:] if a >= e]
        made.append((whole, ([(s, s + len(new), label)] if label else []) + moved))
    return made


def fit(snippets: list[str], epochs: int = EPOCHS, rate: float = 0.3, penalty: float = 1e-3) -> SegmentModel:
    """Conditional log-likelihood by stochastic gradient steps (each weight with its own rate)."""
    examples = []
    for text in snippets:
        gold = base_spans(text)
        examples.append((text, gold))
        examples += _variants(text, gold, zlib.crc32(text.encode()))
    features: dict[str, int] = {}
    lattices = []
    for text, gold in examples:
        tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
        spans = candidates(text, tokens)
        place = {(tokens[i][0], tokens[j - 1][1]): k for k, (i, j) in enumerate(spans)}
        if not spans or any((a, b) not in place for a, b, _ in gold) or any(
                x[1] > y[0] for x, y in zip(gold, gold[1:], strict=False)):
            continue
        ids = [[features.setdefault(f, len(features)) for f in segment_features(text, tokens[i][0], tokens[j - 1][1])]
               for i, j in spans]
        width = len(ids[0])
        truth = np.zeros((len(spans), len(KINDS)))
        for a, b, kind in gold:
            truth[place[a, b], KINDS.index(kind)] = 1
        lattices.append((len(tokens), spans, np.array(ids).reshape(-1, width), truth))
    weights = np.zeros((len(features), len(KINDS)))
    squares = np.full(weights.shape, 1e-6)
    order = np.arange(len(lattices))
    for epoch in range(epochs):
        np.random.default_rng(epoch).shuffle(order)
        for at in order:
            n, spans, ids, truth = lattices[at]
            wrong = truth - marginals(n, spans, weights[ids].sum(axis=1))
            step = np.zeros_like(weights[ids])
            step += wrong[:, None, :]
            used, back = np.unique(ids, return_inverse=True)
            slope = np.zeros((len(used), len(KINDS)))
            np.add.at(slope, back.reshape(-1), step.reshape(-1, len(KINDS)))
            slope -= penalty * weights[used]
            squares[used] += slope ** 2
            weights[used] += rate * slope / np.sqrt(squares[used])
    return SegmentModel(features, weights)


def _searched(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Which texts hold a digit, an at sign or a bracket at all."""
    hit = np.zeros(256, bool)
    hit[[*range(48, 58), ord("@"), ord("["), ord("(")]] = True
    total = np.concatenate([[0], np.cumsum(hit[data], dtype=np.int64)])
    return total[offs[1:]] > total[offs[:-1]]


def _texts(column: pa.Array) -> Iterator[tuple[int, str]]:
    """(row, text) of the texts of a column that need a search."""
    data, offs = text_bytes(column)
    for k in np.flatnonzero(_searched(data, offs)).tolist():
        yield k, data[offs[k]:offs[k + 1]].tobytes().decode()


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def train(docs: DataFrame, snippets: int = SNIPPETS, id_col: str = "doc_id", text_col: str = "text") -> SegmentModel:
    """Fits the model on the ``snippets`` snippets of all texts with the smallest hashes, two thirds of them around base spans."""
    shares = {**dict.fromkeys(KINDS, snippets // 6), "none": snippets // 3}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, int]] = {kind: {} for kind in shares}  # snippet: hash; the smallest ones

        def smallest(kind: str) -> None:
            if len(held[kind]) > shares[kind]:
                held[kind] = dict(sorted(held[kind].items(), key=lambda x: (x[1], x[0]))[:shares[kind]])

        for batch in batches:
            for _, text in _texts(batch.column(1)):
                base = base_spans(text)
                found = [(kind, max(0, s - 40), e + 40) for s, e, kind in base]
                found += [("none", lo, hi) for lo, hi in _regions(text, base)]
                for kind, lo, hi in found:
                    snippet = text[lo:hi]
                    held[kind][snippet] = int.from_bytes(hashlib.md5(snippet.encode()).digest()[:7], "big")
                    if len(held[kind]) > 4 * shares[kind] + 64:
                        smallest(kind)
        for kind in shares:
            smallest(kind)
        rows = [(kind, h, snippet) for kind, own in held.items() for snippet, h in own.items()]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                               pa.array([r[2] for r in rows], pa.string())], ["kind", "h", "snippet"])

    cuts = stored(_rows(docs, id_col, text_col).mapInArrow(tidied(cut), "kind string, h bigint, snippet string"),
                  "pii-snippets")
    chosen: list[str] = []
    for kind, n in shares.items():
        best = cuts.filter(F.col("kind") == kind).distinct().orderBy("h", "snippet").limit(n)
        chosen += [r["snippet"] for r in best.collect()]
    return fit(chosen)


def find_pii(docs: DataFrame, model: SegmentModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans: array of (kind, start, end, base)) of every row, by start, then kind; code points."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the features of SNIPPETS snippets

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                        ("base", pa.bool_())]))
        for batch in batches:
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for k, text in _texts(batch.column(1)):
                spans[k] = [{"kind": kind, "start": s, "end": e, "base": own}
                            for s, e, kind, own in all_spans(text, model)]
            yield pa.record_batch([batch.column(0), pa.array(spans, kind_type)], ["doc_id", "spans"])

    return _rows(docs, id_col, text_col).mapInArrow(
        tidied(search), "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")


def all_spans(text: str, model: SegmentModel) -> list[tuple[int, int, str, bool]]:
    """(start, end, kind, base) of a text, by start, then kind as listed."""
    base = base_spans(text)
    both = [(*x, True) for x in base] + [(*x, False) for x in added_spans(text, base, model)]
    return sorted(both, key=lambda x: (x[0], KINDS.index(x[2])))


def redact_text(text: str, spans: list[tuple[int, int, str, bool]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by its (first) kind in brackets."""
    out, at = [], 0
    for s, e, kind, _ in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: SegmentModel, text_col: str = "text") -> DataFrame:
    """``docs`` with the personal data of every text replaced by its kind; same columns, null texts stay null."""
    bounded_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at, rows = docs.columns.index(text_col), by_place(docs)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in batches:
            column = batch.column(at)
            new: dict[int, str] = {}
            for k, text in _texts(column):
                spans = all_spans(text, model)
                if spans:
                    new[k] = redact_text(text, spans)
            if new:
                texts = column.to_pylist()
                for k, text in new.items():
                    texts[k] = text
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, column.type))
            yield batch

    return rows.mapInArrow(tidied(rewrite), rows.schema).toDF(*docs.columns)


def op4_pii_semi_crf(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_pii(docs, train(docs))
    base = F.filter("spans", lambda x: x["base"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def number(kind: str):
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))
