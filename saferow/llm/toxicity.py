"""Toxicity: bidirectional gated recurrent network with attention pooling.

Inputs of a word: a trained embedding of the word, the mean of trained embeddings of its
character n-grams (with word-edge marks), the word's log-odds between toxic
and clean training texts, and the largest and the mean log-odds of its character
n-grams, so unseen words with known parts count too.  Two gated recurrent layers read the
text forwards and backwards; attention pools their states over a window of
``WIDTH`` words to one logit.  Every window of a text is scored, at every word, and the
text's score is that of its worst window.

All windows at the cost of one reading: the layers read each text once, in blocks of ``BLOCK``
words that start ``CONTEXT`` words early in their direction of reading (from a zero state, counted from the
start of the text, so a score depends on nothing but the text).  A window's pooled logit is a ratio of two
sums over its words, of exp(attention) times the state's output and of exp(attention); both come from
running sums.

Training (numpy, on the driver) uses a bounded sample of labelled rows:
``POSITIVES`` and ``NEGATIVES`` rows in order of a hash of the id, none longer
than ``FIT_CHARS``; of a repeated id the least text.  A text's label does not say which window earns it, so rounds
alternate: score all windows of the sample, then fit on the worst ones of each
text (of those at every ``FIT_STRIDE``-th word, so that they differ), each with
``CONTEXT`` words around it.  Rows that the caller holds out are never used.

Scoring is a map without shuffle; the model is of fixed size and is broadcast.

Defined results: null, empty and word-less texts score 0; without labelled rows
of both classes every score is 0; repeated rows score alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saferow.llm.common import LOWER, byte_class, chunks, span_hashes, words

WIDTH, BLOCK, CONTEXT, FIT_STRIDE = 24, 56, 8, 4
HIDDEN, EMBED, CHAR_EMBED = 8, 5, 4
WORD_BUCKETS, CHAR_BUCKETS = 1 << 16, 1 << 17
CHAR_GRAMS = (3, 4, 5)
POSITIVES, NEGATIVES, FIT_CHARS = 1500, 3000, 30_000
LEAST_SEEN, LEAST_STEPS = 3, 60
THRESHOLD = 0.7
SCORE = "__sf_score"
WORD_BYTE = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_F = np.float32


# ------------------------------------------------------------------ text side
class Words:
    """Distinct words of a chunk of texts, their character n-grams, and the windows."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        low = LOWER[data]
        starts, ends, self.first = words(low, off, WORD_BYTE)
        h = span_hashes(low, starts, ends)
        self.distinct, at, self.of = np.unique(h, return_index=True, return_inverse=True)
        self.bucket = (self.distinct % np.uint64(WORD_BUCKETS)).astype(np.int64)
        # the distinct words once more, each between edge marks
        size = (ends - starts)[at]
        edge = np.concatenate([[0], np.cumsum(size + 2)])
        buf = np.zeros(edge[-1], np.uint8)
        buf[edge[:-1]], buf[edge[1:] - 1] = 1, 2
        src = np.repeat(starts[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
        buf[np.repeat(edge[:-1] + 1 - np.cumsum(size) + size, size) + np.arange(size.sum())] = low[src]
        owner, grams = [], []
        word = np.repeat(np.arange(len(size)), size + 2)
        for n in CHAR_GRAMS:
            m = len(buf) - n + 1
            if m <= 0:
                continue
            v = np.full(m, n, np.uint64)
            for j in range(n):
                v = v * np.uint64(0x100000001B3) + buf[j:j + m]
            ok = word[:m] == word[n - 1:]
            owner.append(word[:m][ok])
            grams.append(((v[ok] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(47)).astype(np.int64))
        owner, grams = np.concatenate([*owner, np.zeros(0, np.int64)]), np.concatenate([*grams, np.zeros(0, np.int64)])
        order = np.argsort(owner, kind="stable")
        self.grams = grams[order].astype(np.int32)
        self.gram_at = np.searchsorted(owner[order], np.arange(len(size)))

    def starts(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, first word) of every window; a row of fewer than ``WIDTH`` words is one window."""
        n = np.diff(self.first)
        count = np.where(n == 0, 0, np.maximum(1, n - WIDTH + 1))
        row = np.repeat(np.arange(len(n)), count)
        return row, self.first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)

    def around(self, row: np.ndarray, start: np.ndarray, width: int, context: int) -> np.ndarray:
        """Word numbers of ``width`` words from each start and ``context`` words on either side;
        -1 outside the row."""
        at = start[:, None] + np.arange(-context, width + context)
        inside = (at >= self.first[row][:, None]) & (at < self.first[row + 1][:, None])
        return np.where(inside, self.of[np.clip(at, 0, max(len(self.of) - 1, 0))], -1) if len(self.of) else at * 0 - 1

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(row of each window, its word numbers with -1 past the row's end)."""
        row, start = self.starts()
        return row, self.around(row, start, WIDTH, 0)

    def features(self, model: dict) -> np.ndarray:
        """Input vector of each distinct word."""
        odds = model["char_odds"][self.grams]
        top = np.maximum.reduceat(odds, self.gram_at) if len(odds) else np.zeros(0, _F)
        mean = np.add.reduceat(odds, self.gram_at) / np.diff(np.append(self.gram_at, len(odds))) if len(odds) else top
        return np.column_stack([model["word_odds"][self.bucket], top, mean, model["embed"][self.bucket],
                                spelled(model["char_embed"], self.grams, np.append(self.gram_at, len(self.grams)))]).astype(_F)


def spelled(char_embed: np.ndarray, grams: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Mean embedding of the character n-grams of each word (n-grams ``edge[i]`` to ``edge[i + 1]``)."""
    if not len(grams):
        return np.zeros((len(edge) - 1, CHAR_EMBED), _F)
    return np.add.reduceat(char_embed[grams], edge[:-1], axis=0) / np.diff(edge)[:, None].astype(_F)


ODDS = 3
INPUTS = ODDS + EMBED + CHAR_EMBED


# ----------------------------------------------------------------- the network
def new_model(rng: np.random.Generator) -> dict:
    def draw(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[-2])).astype(_F)

    return {"embed": (0.1 * rng.standard_normal((WORD_BUCKETS, EMBED))).astype(_F),
            "char_embed": (0.1 * rng.standard_normal((CHAR_BUCKETS, CHAR_EMBED))).astype(_F),
            "word_odds": np.zeros(WORD_BUCKETS, _F), "char_odds": np.zeros(CHAR_BUCKETS, _F),
            "wx": draw(2, INPUTS, 3 * HIDDEN), "b": np.zeros((2, 1, 3 * HIDDEN), _F), "u": draw(2, HIDDEN, 3 * HIDDEN),
            "wa": draw(2 * HIDDEN, HIDDEN), "va": draw(HIDDEN, 1), "wo": draw(2 * HIDDEN, 1),
            "bo": np.full(1, -1.0, _F)}


WEIGHTS = ("wx", "b", "u", "wa", "va", "wo", "bo")


def _sigmoid(x):
    return _F(0.5) * np.tanh(_F(0.5) * x) + _F(0.5)


def read(model: dict, projected: np.ndarray, ids: np.ndarray, width: int, keep: bool = False):
    """States of both layers at the ``width`` middle words of each row of ``ids``; each layer starts at
    the edge it reads from.  ``projected``: (2, words + 1, 3H), its last row for padding."""
    context, n, h = (ids.shape[1] - width) // 2, len(ids), HIDDEN
    steps = context + width
    both = np.stack([ids[:, :steps], ids[:, ::-1][:, :steps]])  # the second layer reads backwards
    mask = (both >= 0).astype(_F)
    state, states, saved = np.zeros((2, n, h), _F), np.empty((steps, 2, n, h), _F), []
    for t in range(steps):
        x = np.stack([projected[0][both[0, :, t]], projected[1][both[1, :, t]]])
        g = state @ model["u"]
        zr = _sigmoid(x[..., :2 * h] + g[..., :2 * h])
        z, r = zr[..., :h], zr[..., h:]
        c = np.tanh(x[..., 2 * h:] + r * g[..., 2 * h:])
        m = mask[:, :, t, None]
        new = state + m * (1 - z) * (c - state)
        if keep:
            saved.append((state, z, r, c, g[..., 2 * h:], m))
        state = states[t] = new
    hidden = np.concatenate([states[context:, 0], states[context:, 1][::-1]], axis=2).transpose(1, 0, 2)  # n, width, 2H
    return hidden, both, saved


def forward(model: dict, projected: np.ndarray, ids: np.ndarray, keep: bool = False):
    """Logit of the window of ``WIDTH`` words in the middle of each row of ``ids``."""
    hidden, both, saved = read(model, projected, ids, WIDTH, keep)
    context = (ids.shape[1] - WIDTH) // 2
    real = (ids[:, context:context + WIDTH] >= 0).astype(_F)
    a = np.tanh(hidden @ model["wa"])
    e = (a @ model["va"])[..., 0] - _F(1e9) * (1 - real)
    p = np.exp(e - e.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    pooled = (p[..., None] * hidden).sum(1)
    logit = (pooled @ model["wo"])[:, 0] + model["bo"]
    return (logit, (both, saved, hidden, a, p, pooled)) if keep else logit


def backward(model: dict, kept, d_logit: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
    """Gradients of the weights, and d(projected) with its word numbers, by direction and step."""
    both, saved, hidden, a, p, pooled = kept
    h, d = HIDDEN, {}
    d_logit = d_logit.astype(_F)[:, None]
    d["wo"], d["bo"] = pooled.T @ d_logit, d_logit.sum(0)
    d_pooled = d_logit @ model["wo"].T
    d_hidden = p[..., None] * d_pooled[:, None]
    d_p = (hidden * d_pooled[:, None]).sum(2)
    d_e = p * (d_p - (p * d_p).sum(1, keepdims=True))
    d["va"] = np.einsum("ntk,nt->k", a, d_e)[:, None]
    d_a = d_e[..., None] * model["va"][:, 0] * (1 - a * a)
    d["wa"] = np.einsum("nti,ntk->ik", hidden, d_a)
    d_hidden = (d_hidden + d_a @ model["wa"].T).transpose(1, 0, 2)
    steps = len(saved)
    d_states = np.zeros((steps, 2, both.shape[1], h), _F)  # the words before a window count only through the state
    d_states[steps - WIDTH:] = np.stack([d_hidden[..., :h], d_hidden[::-1, :, h:]], axis=1)
    d["u"], d_x = np.zeros_like(model["u"]), np.empty((steps, 2, both.shape[1], 3 * h), _F)
    carry = np.zeros_like(d_states[0])
    for t in reversed(range(steps)):
        state, z, r, c, gc, m = saved[t]
        d_new = d_states[t] + carry
        d_c = d_new * m * (1 - z) * (1 - c * c)
        d_z = -d_new * m * (c - state) * z * (1 - z)
        d_r = d_c * gc * r * (1 - r)
        d_x[t] = np.concatenate([d_z, d_r, d_c], axis=2)
        d_g = np.concatenate([d_z, d_r, d_c * r], axis=2)
        d["u"] += state.transpose(0, 2, 1) @ d_g
        carry = d_new * (1 - m * (1 - z)) + d_g @ model["u"].transpose(0, 2, 1)
    return d, d_x, both


def _projected(model: dict, x: np.ndarray) -> np.ndarray:
    x = np.concatenate([x, np.zeros((1, INPUTS), _F)])
    return x @ model["wx"] + model["b"]


def word_outputs(model: dict, w: Words, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """(attention, output) of every word of a chunk: the logit of words s to t is the mean of the
    outputs weighted by exp(attention)."""
    n = np.diff(w.first)
    blocks = -(-n // BLOCK)
    row = np.repeat(np.arange(len(n)), blocks)
    start = w.first[row] + BLOCK * (np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    size = np.minimum(start + BLOCK, w.first[row + 1]) - start
    attention, output = np.zeros(len(w.of)), np.zeros(len(w.of))
    projected = _projected(model, w.features(model))
    order = np.argsort(size, kind="stable")  # blocks of like size together: little padding
    for k in range(0, len(order), block):
        take = order[k:k + block]
        width = int(size[take].max())
        hidden, _, _ = read(model, projected, w.around(row[take], start[take], width, CONTEXT), width)
        at = start[take][:, None] + np.arange(width)
        inside = np.arange(width) < size[take][:, None]
        attention[at[inside]] = (np.tanh(hidden @ model["wa"]) @ model["va"])[..., 0][inside]
        output[at[inside]] = (hidden @ model["wo"])[..., 0][inside]
    return attention, output


def window_logits(model: dict, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, logit) of every window of a chunk."""
    row, start = w.starts()
    attention, output = word_outputs(model, w)
    weight = np.exp(attention)  # bounded: attention is a sum of HIDDEN terms of at most |va| each
    below = np.concatenate([[0.0], np.cumsum(weight)])
    above = np.concatenate([[0.0], np.cumsum(weight * output)])
    end = np.minimum(start + WIDTH, w.first[row + 1])
    return row, start, (above[end] - above[start]) / (below[end] - below[start]) + float(model["bo"][0])


# -------------------------------------------------------------------- training
def _log_odds(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int, smooth: float = 2.0) -> np.ndarray:
    odds = np.log((pos + smooth) / (n_pos + 2 * smooth)) - np.log((neg + smooth) / (n_neg + 2 * smooth))
    return np.where(pos + neg >= LEAST_SEEN, odds, 0.0).astype(_F)


def fit(texts: list[str], labels: np.ndarray, seed: int = 5, rounds: int = 3, epochs: int = 3) -> dict:
    """Fit on whole sample texts; deterministic for a given sample order."""
    rng = np.random.default_rng(seed)
    model = new_model(rng)
    labels = np.asarray(labels)
    n_pos, n_neg = int((labels == 1).sum()), int((labels == 0).sum())
    model["trained"] = bool(n_pos and n_neg)
    if not model["trained"]:
        return model
    rank = np.empty(0, np.int64)
    counts = {k: np.zeros((2, n)) for k, n in (("word", WORD_BUCKETS), ("char", CHAR_BUCKETS))}
    parts = []
    for lo, hi, data, off in chunks(pa.array(texts, pa.string())):
        w = Words(data, off)
        parts.append((w, lo))
        for k in range(hi - lo):  # in how many texts of each class a bucket occurs
            seen = np.unique(w.of[w.first[k]:w.first[k + 1]])
            counts["word"][labels[lo + k], np.unique(w.bucket[seen])] += 1
            grams = np.concatenate([w.grams[w.gram_at[s]:(w.gram_at[s + 1] if s + 1 < len(w.gram_at) else None)]
                                    for s in seen] + [rank])
            counts["char"][labels[lo + k], np.unique(grams)] += 1
    for k, (neg, pos) in counts.items():
        model[f"{k}_odds"] = _log_odds(pos, neg, n_pos, n_neg)

    moments = {k: [np.zeros_like(model[k]), np.zeros_like(model[k])] for k in WEIGHTS}
    grown = {"embed": np.full(WORD_BUCKETS, 1e-3, _F), "char_embed": np.full(CHAR_BUCKETS, 1e-3, _F)}
    step, bucket = 0, np.concatenate([w.bucket for w, _ in parts])
    before = np.cumsum([0] + [len(w.bucket) for w, _ in parts])  # words of earlier chunks
    n_grams = np.cumsum([0] + [len(w.grams) for w, _ in parts])
    grams = np.concatenate([w.grams for w, _ in parts])
    edge = np.concatenate([w.gram_at + n for (w, _), n in zip(parts, n_grams)] + [n_grams[-1:]])
    for turn in range(rounds):
        batch_odds, batch_ids, batch_y = [], [], []
        for (w, lo), shift in zip(parts, before):
            x = w.features(model)
            batch_odds.append(x[:, :ODDS])
            if turn == 0:  # before the network knows anything: windows by their strongest word
                row, start = w.starts()
                strong, last = np.maximum(x[:, 0], x[:, 1])[w.of], w.first[row + 1] - 1
                logit = np.full(len(row), -9, _F)
                for j in range(WIDTH):
                    np.maximum(logit, strong[np.minimum(start + j, last)], out=logit)
            else:
                row, start, logit = window_logits(model, w)
            some = (start - w.first[row]) % FIT_STRIDE == 0
            row, start, logit = row[some], start[some], logit[some]
            order = np.lexsort((-logit, row))
            place = np.arange(len(row)) - np.searchsorted(row[order], row[order])
            take = order[place < np.where(labels[lo + row[order]] == 1, 2, 4)]
            ids = w.around(row[take], start[take], WIDTH, CONTEXT)
            batch_ids.append(np.where(ids >= 0, ids + shift, -1))
            batch_y.append(labels[lo + row[take]])
        odds, ids, y = map(np.concatenate, (batch_odds, batch_ids, batch_y))
        batches = max(1, len(ids) // 256)
        for _ in range(max(epochs, -(-LEAST_STEPS // batches))):  # small samples: more often
            for take in np.array_split(rng.permutation(len(ids)), batches):
                used, local = np.unique(ids[take], return_inverse=True)
                local = local.reshape(ids[take].shape) - (used[0] < 0)
                used = used[used >= 0]
                size = np.diff(edge)[used]
                mine = np.concatenate([[0], np.cumsum(size)])
                own = grams[np.repeat(edge[used] - mine[:-1], size) + np.arange(mine[-1])]  # the n-grams of these words
                xu = np.column_stack([odds[used], model["embed"][bucket[used]], spelled(model["char_embed"], own, mine)]).astype(_F)
                logit, kept = forward(model, _projected(model, xu), local, keep=True)
                grad, d_x, both = backward(model, kept, (_sigmoid(logit) - y[take]) / len(take))
                d_proj = np.zeros((2, len(used) + 1, 3 * HIDDEN), _F)
                for s in range(2):
                    np.add.at(d_proj[s], both[s].T.ravel(), d_x[:, s].reshape(-1, 3 * HIDDEN))
                d_proj = d_proj[:, :-1]  # padding
                grad["wx"] = xu.T @ d_proj
                grad["b"] = d_proj.sum(1, keepdims=True)
                d_in = (d_proj @ model["wx"].transpose(0, 2, 1)).sum(0)
                d_embed, d_spell = d_in[:, ODDS:ODDS + EMBED], d_in[:, ODDS + EMBED:]
                step += 1
                for k in WEIGHTS:
                    m, v = moments[k]
                    m += _F(0.1) * (grad[k] - m)
                    v += _F(0.01) * (grad[k] ** 2 - v)
                    model[k] -= _F(0.01) * (m / _F(1 - 0.9 ** step)) / (np.sqrt(v / _F(1 - 0.99 ** step)) + _F(1e-7))
                d_gram = np.repeat(d_spell / np.maximum(size, 1)[:, None].astype(_F), size, axis=0)
                for k, at, d in (("embed", bucket[used], d_embed), ("char_embed", own, d_gram)):
                    np.add.at(grown[k], at, (d ** 2).mean(1))
                    np.add.at(model[k], at, -_F(0.02) * d / np.sqrt(grown[k][at])[:, None])
    return model


def score_chunk(model: dict, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Score of each row: its worst window."""
    out = np.zeros(len(off) - 1)
    if not model["trained"]:
        return out
    w = Words(data, off)
    if len(w.of):
        row, _, logit = window_logits(model, w)
        full = np.unique(row)
        out[full] = 1 / (1 + np.exp(-np.maximum.reduceat(logit, np.searchsorted(row, full))))
    return out


# --------------------------------------------------------------------- on Spark
def held_out(doc_id) -> "F.Column":
    return F.crc32(doc_id.cast("string")) % 3 == 1


def fit_on(docs: DataFrame, labels: DataFrame, exclude=held_out) -> dict:
    """Model from the bounded sample of labelled rows that ``exclude`` does not hold out."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    if exclude is not None:
        known = known.where(~exclude(F.col("doc_id")))
    known = known.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").alias("_y")).distinct()
    pick = [known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
            for y, n in ((1, POSITIVES), (0, NEGATIVES))]
    ids = F.broadcast(pick[0].unionByName(pick[1]))  # at most POSITIVES + NEGATIVES rows
    got = docs.select("doc_id", "text").where(F.length("text") <= FIT_CHARS) \
        .join(ids, F.col("doc_id") == F.col("_id")).groupBy("_id", "_y").agg(F.min("text").alias("text"))
    rows = sorted(got.collect(), key=lambda r: (r[0], r[1], r[2]))  # one row per id and label
    return fit([r[2] for r in rows], np.array([r[1] for r in rows], np.int64))


def toxicity_scores(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` (any columns, among them text) with a score column; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            score = np.zeros(b.num_rows)
            for lo, hi, data, off in chunks(b.column("text")):
                score[lo:hi] = score_chunk(shared.value, data, off)
            yield b.append_column(SCORE, pa.array(score))

    schema = T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = toxicity_scores(rows, fit_on(docs, labels))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                      F.col(SCORE).alias("score"), (F.col(SCORE) >= THRESHOLD).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below the threshold (columns kept)."""
    scored = toxicity_scores(docs, fit_on(docs, labels))
    return scored.where(F.col(SCORE) < THRESHOLD).select(*[f"`{c}`" for c in docs.columns])
