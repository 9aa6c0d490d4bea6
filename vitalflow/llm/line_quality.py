"""Quality rules: lines labelled content or boilerplate by a linear-chain CRF.

Every line with a word gets a vector of measures; a conditional random field scores each label
by those and each step from label to label, and Viterbi decoding finds the best sequence. A
document is kept if it passes two base rules and content lines hold at least `min_content` of
its words.

There are no labels of lines, so the field is trained from the quality labels of documents:
lines start with the label of their document, the field is fitted by maximum likelihood, lines
of poor documents that it then decodes as content are relabelled, unless that would leave a
document without any boilerplate, and it is fitted again. The sample is bounded: at most SAMPLE
labelled documents. Their whole texts teach, in overlapping sequences of TRAIN_LINES lines.

Base measures follow the words `[^\\x20\\x09-\\x0D]+` of the whole text. Nulls: a null or empty
text has no words and fails a base rule; documents whose doc_id is null are judged like others
but can't be labelled. Without any labels of either kind all lines are content. Repeated rows
are kept; a document with several labels counts as poor if one is. Empty tables give no rows.
Other columns are carried in a struct.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, bounded_sample

SAMPLE, TRAIN_LINES, ROUNDS = 4000, 64, 3
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_CONTENT = 10, 20, 0.5
WINDOW = 5
CONTENT, BOILERPLATE = 0, 1
_WORDS = re.compile(WORD).findall
_SYMBOLS, _UPPER, _LOWER = b"#*$%&|<>", bytes(range(65, 91)), bytes(range(97, 123))
_DIGITS, _POINTS = b"0123456789", b"\"'(),-./:;?[]_{}!"
_STOPS = ('.', '!', '?', '…', '"', '»', '”', ':')
#: Words of notices, menus and forms, as fixed values.
_NOTICES = re.compile(
    r"copyright|licen[sc]ed?|rights reserved|cookie|javascript|log ?in|sign up|subscribe|"
    r"privacy policy|terms of|all rights|newsletter|click here|©",
    re.IGNORECASE,
).search
FEATURES = 16


def repeated_words(words: Sequence[str]) -> int:
    """Words that lie in a window of 5 words found twice or more in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    numbers: dict[str, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    pairs = np.unique(codes[:-1] * len(numbers) + codes[1:], return_inverse=True)[1]
    fours = np.unique(pairs[:-2] * n + pairs[2:], return_inverse=True)[1]
    fives, counts = np.unique(fours[:-1] * len(numbers) + codes[4:], return_inverse=True, return_counts=True)[1:]
    again = np.flatnonzero(counts[fives] > 1)
    if not len(again):
        return 0
    covered = np.zeros(n + 1, np.int64)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + WINDOW, -1)
    return int((np.cumsum(covered)[:n] > 0).sum())


def describe(text: str | None) -> tuple[list[int], list[tuple], list[int]]:
    """Base measures of a text; a vector of measures and the words of each line with a word."""
    vectors, sizes, seen = [], [], set()
    every: list[str] = []
    word_chars = symbols = duplicates = 0
    for line in (text or "").split("\n"):
        words = _WORDS(line)
        if not words:
            continue
        data = line.encode("utf-8", "surrogatepass")
        size, n = len(data), len(words)
        marks = size - len(data.translate(None, _SYMBOLS))
        upper = size - len(data.translate(None, _UPPER))
        lower = size - len(data.translate(None, _LOWER))
        digits = size - len(data.translate(None, _DIGITS))
        points = size - len(data.translate(None, _POINTS))
        chars = sum(map(len, words))
        again = line in seen
        seen.add(line)
        every += words
        word_chars += chars
        symbols += marks
        duplicates += again
        ends = line.rstrip().endswith(_STOPS)
        vectors.append(
            (
                1.0,
                min(1.0, marks / n),
                upper / (upper + lower + 1),
                digits / size,
                min(1.0, points / n / 2),
                min(1.0, data.count(b"!!") / n),
                min(1.0, data.count(b"|") / n),
                again,
                1 - len(set(words)) / n,
                min(n, 64) ** 0.5 / 8,
                n < 4,
                min(1.0, chars / n / 16),
                ends,
                _NOTICES(line) is not None,
                marks > 0,
                min(1.0, data.count(b"&") / n),
            )
        )
        sizes.append(n)
    return [len(every), word_chars, symbols, duplicates, repeated_words(every)], vectors, sizes


class Field:
    """A linear-chain conditional random field with two labels."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray, start: np.ndarray):
        self.weights, self.steps, self.start = weights, steps, start

    def decode(self, scores: np.ndarray) -> list[int]:
        """Viterbi: the best label sequence for rows of (content, boilerplate) scores.

        Ties go to content.
        """
        (cc, cb), (bc, bb) = self.steps.tolist()
        content, boiler = (scores[0] + self.start).tolist()
        from_content, from_boiler = [], []
        for c, b in scores[1:].tolist():
            stay, turn = content + cc, boiler + bc
            leave, remain = content + cb, boiler + bb
            from_content.append(stay >= turn)
            from_boiler.append(leave >= remain)
            content, boiler = max(stay, turn) + c, max(leave, remain) + b
        label = CONTENT if content >= boiler else BOILERPLATE
        labels = [label]
        for to_content, to_boiler in zip(reversed(from_content), reversed(from_boiler)):
            label = CONTENT if (to_content if label == CONTENT else to_boiler) else BOILERPLATE
            labels.append(label)
        return labels[::-1]


def fit(docs: list[np.ndarray], labels: list[np.ndarray], epochs: int = 60, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """Maximum likelihood by forward and backward passes over all documents at once (Adam)."""
    n, longest = len(docs), max(map(len, docs))
    x = np.zeros((n, longest, FEATURES))
    y = np.zeros((n, longest), np.int64)
    real = np.zeros((n, longest), bool)
    for i, (d, t) in enumerate(zip(docs, labels)):
        x[i, : len(d)], y[i, : len(d)], real[i, : len(d)] = d, t, True
    onehot = np.eye(2)[y] * real[..., None]
    both = real[:, 1:]
    seen_steps = np.einsum("nti,ntj->ij", onehot[:, :-1], onehot[:, 1:] * both[..., None])
    seen = [np.einsum("ntf,ntl->fl", x, onehot), seen_steps, onehot[:, 0].sum(0)]
    params = [np.zeros((FEATURES, 2)), np.zeros((2, 2)), np.zeros(2)]
    moment = [np.zeros_like(p) for p in params]
    square = [np.zeros_like(p) for p in params]
    lines = real.sum()

    def logsum(a, axis):
        top = a.max(axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis))

    for epoch in range(1, epochs + 1):
        w, steps, start = params
        scores = x @ w
        ahead = np.zeros((n, longest, 2))
        ahead[:, 0] = scores[:, 0] + start
        for t in range(1, longest):
            now = logsum(ahead[:, t - 1, :, None] + steps, 1) + scores[:, t]
            ahead[:, t] = np.where(real[:, t, None], now, ahead[:, t - 1])
        back = np.zeros((n, longest, 2))
        for t in range(longest - 2, -1, -1):
            now = logsum(steps + (scores[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(real[:, t + 1, None], now, 0.0)
        total = logsum(ahead[:, -1], 1)
        share = np.exp(ahead + back - total[:, None, None]) * real[..., None]
        pair = ahead[:, :-1, :, None] + steps + (scores[:, 1:] + back[:, 1:])[:, :, None, :]
        pair = np.exp(np.minimum(pair - total[:, None, None, None], 0)) * both[..., None, None]
        expected = [np.einsum("ntf,ntl->fl", x, share), pair.sum((0, 1)), share[:, 0].sum(0)]
        for k, p in enumerate(params):
            slope = (seen[k] - expected[k]) / lines - decay * p
            moment[k] = 0.9 * moment[k] + 0.1 * slope
            square[k] = 0.999 * square[k] + 0.001 * slope**2
            step = rate * (moment[k] / (1 - 0.9**epoch)) / (np.sqrt(square[k] / (1 - 0.999**epoch)) + 1e-8)
            params[k] = p + step * (1 - epoch / (epochs + 1))
    return Field(*params)


def chunks(lines: np.ndarray) -> list[np.ndarray]:
    """A text's lines in sequences of at most TRAIN_LINES, each beginning with the last line of the one before."""
    step = TRAIN_LINES - 1
    return [lines[at : at + TRAIN_LINES] for at in range(0, max(len(lines) - 1, min(len(lines), 1)), step)]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field | None:
    """The field from documents and their quality labels (1 good, 0 poor); None without both."""
    known = labels.filter("doc_id is not null and quality is not null")
    chosen = bounded_sample(known.groupBy("doc_id").agg(F.min("quality").alias("quality")), F.col("doc_id"), sample)
    # at most `sample` rows of two numbers; ties by text, so that runs agree
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = texts.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(sample).select("quality", "text")

    def run(batches):
        for batch in batches:
            quality, texts, lines = [], [], []
            for q, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = zlib.crc32((t.as_py() or "").encode("utf-8", "surrogatepass"))
                for part in chunks(np.array(describe(t.as_py())[1], np.float32).reshape(-1, FEATURES)):
                    quality.append(q)
                    texts.append(text)
                    lines.append(part.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(quality, pa.int32()), pa.array(texts, pa.int64()), pa.array(lines, pa.binary())],
                ["quality", "text", "lines"],
            )

    rows = texts.mapInArrow(run, "quality int, text long, lines binary").collect()
    # an order of their own, so that runs agree
    rows = sorted((r["quality"] <= 0, r["text"], bytes(r["lines"])) for r in rows)
    poor = [p for p, _, _ in rows]
    if not any(poor) or all(poor):
        return None
    vectors = [np.frombuffer(d, np.float32).reshape(-1, FEATURES).astype(float) for _, _, d in rows]
    marks = [np.full(len(v), int(p)) for p, v in zip(poor, vectors)]
    for turn in range(ROUNDS):
        field = fit(vectors, marks)
        if turn + 1 < ROUNDS:
            decoded = {i: np.array(field.decode(vectors[i] @ field.weights)) for i, p in enumerate(poor) if p}
            some = {rows[i][1] for i, d in decoded.items() if d.any()}
            for i, d in decoded.items():
                marks[i] = d if rows[i][1] in some else np.ones(len(d), np.int64)
    return field


def judge(
    docs: DataFrame,
    field: Field | None,
    keep: list[str] | None = None,
    min_content: float = MIN_CONTENT,
) -> DataFrame:
    """row (struct of the kept columns), base measures, base_failed, content_share, kept."""
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs["text"].alias("text"))
    schema = (
        f"row {rows.schema['row'].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"
    )
    names = [c.strip().split()[0] for c in schema[schema.index(", n_words") + 1 :].split(",")]

    def run(batches):
        for batch in batches:
            base, shares, vectors, spans = [], [], [], []
            for text in batch.column(1):
                measures, lines, sizes = describe(text.as_py())
                base.append(measures)
                spans.append((len(vectors), sizes))
                vectors += lines
            scores = np.array(vectors, float).reshape(-1, FEATURES) @ field.weights if field else None
            for at, sizes in spans:
                if not sizes:
                    shares.append(0.0)
                elif field is None:
                    shares.append(1.0)
                else:
                    labels = field.decode(scores[at : at + len(sizes)])
                    shares.append(sum(s for s, l in zip(sizes, labels) if l == CONTENT) / sum(sizes))
            measures = np.array(base, np.int64).reshape(-1, 5)
            failed = (measures[:, 0] < MIN_WORDS) | (100 * measures[:, 4] > MAX_REPEAT_PERCENT * measures[:, 0])
            share = np.array(shares)
            columns = [batch.column(0), *map(pa.array, measures.T), pa.array(failed), pa.array(share)]
            columns.append(pa.array(~failed & (share >= min_content)))
            yield pa.RecordBatch.from_arrays(columns, ["row", *names])

    return rows.mapInArrow(run, schema)
