"""Toxicity and language identification: learning, edges, and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from saferow.llm import langid, simhash, toxicity
from saferow.llm.common import table

from llm_data import EDGES, EMPTY, SCHEMA

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    model = toxicity.new_model(rng)
    x = rng.standard_normal((7, toxicity.INPUTS)).astype(np.float32)
    ids = rng.integers(-1, 7, (5, toxicity.WIDTH))
    ids[:, 0] = 1
    y = np.array([0, 1, 0, 1, 1])

    def loss(m):
        z = toxicity.forward(m, toxicity._projected(m, x), ids).astype(float)
        return float(np.sum(np.log1p(np.exp(z)) - y * z))

    logit, kept = toxicity.forward(model, toxicity._projected(model, x), ids, keep=True)
    grad, d_x, both = toxicity.backward(model, kept, 1 / (1 + np.exp(-logit)) - y)
    for name in ("u", "wa", "va", "wo", "bo"):
        at = tuple(rng.integers(0, s) for s in model[name].shape)
        step = {k: v.copy() if hasattr(v, "copy") else v for k, v in model.items()}
        step[name][at] += 0.01
        up = loss(step)
        step[name][at] -= 0.02
        assert grad[name][at] == pytest.approx((up - loss(step)) / 0.02, rel=0.05, abs=0.02)


def _plain_score(model, text):
    """The network by loops over words: each layer restarts every BLOCK words, CONTEXT words early;
    every window is pooled by itself; the worst counts."""
    T = toxicity
    data = np.frombuffer(text.encode(), np.uint8)
    w = T.Words(data, np.array([0, len(data)]))
    n = len(w.of)
    if not n:
        return 0.0
    x = w.features(model)[w.of].astype(float)
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    h = T.HIDDEN

    def step(layer, state, v):
        g, p = state @ model["u"][layer], v @ model["wx"][layer] + model["b"][layer][0]
        z, r = sigmoid(p[:h] + g[:h]), sigmoid(p[h:2 * h] + g[h:2 * h])
        return state + (1 - z) * (np.tanh(p[2 * h:] + r * g[2 * h:]) - state)

    hidden = np.zeros((n, 2 * h))
    for lo in range(0, n, T.BLOCK):
        hi = min(lo + T.BLOCK, n)
        state = np.zeros(h)
        for t in range(max(0, lo - T.CONTEXT), hi):
            state = step(0, state, x[t])
            hidden[t, :h] = state if t >= lo else hidden[t, :h]
        state = np.zeros(h)
        # the second layer starts CONTEXT words after the block's last place, at most at the end of the text
        for t in range(min(n, lo + (T.BLOCK if hi - lo == T.BLOCK else hi - lo) + T.CONTEXT) - 1, lo - 1, -1):
            state = step(1, state, x[t])
            hidden[t, h:] = state if t < hi else hidden[t, h:]
    e = (np.tanh(hidden @ model["wa"]) @ model["va"])[:, 0]
    best = -np.inf
    for s in range(max(1, n - T.WIDTH + 1)):
        p = np.exp(e[s:s + T.WIDTH])
        best = max(best, float((p / p.sum()) @ hidden[s:s + T.WIDTH] @ model["wo"][:, 0] + model["bo"][0]))
    return float(sigmoid(best))


def test_all_windows_equal_the_plain_network():
    rng = np.random.default_rng(3)
    model = toxicity.new_model(rng)
    model["trained"] = True
    for k in ("word_odds", "char_odds"):
        model[k] = rng.standard_normal(len(model[k])).astype(np.float32)
    vocabulary = [f"w{'abcdefg'[i % 7]}{i}é" for i in range(90)]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in (1, 5, 23, 24, 25, 56, 57, 64, 113, 400)] + ["", " ,. "]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = toxicity.score_chunk(model, np.frombuffer(b"".join(raw), np.uint8), off)
    assert np.allclose(got, [_plain_score(model, t) for t in texts], atol=2e-5)
    w = toxicity.Words(np.frombuffer(raw[-3], np.uint8), np.array([0, len(raw[-3])]))
    row, start, logit = toxicity.window_logits(model, w)
    assert list(start) == list(range(400 - toxicity.WIDTH + 1)) and len(logit) == len(start)


def test_gradients_with_words_around_the_window():
    rng = np.random.default_rng(1)
    model = toxicity.new_model(rng)
    x = rng.standard_normal((7, toxicity.INPUTS)).astype(np.float32)
    ids = rng.integers(-1, 7, (5, toxicity.WIDTH + 2 * toxicity.CONTEXT))
    ids[:, toxicity.CONTEXT] = 1
    y = np.array([0, 1, 0, 1, 1])

    def loss(m, inputs=x):
        z = toxicity.forward(m, toxicity._projected(m, inputs), ids).astype(float)
        return float(np.sum(np.log1p(np.exp(z)) - y * z))

    logit, kept = toxicity.forward(model, toxicity._projected(model, x), ids, keep=True)
    grad, d_x, both = toxicity.backward(model, kept, 1 / (1 + np.exp(-logit)) - y)
    for name in ("u", "wa", "va", "wo", "bo"):
        for _ in range(3):
            at = tuple(rng.integers(0, s) for s in model[name].shape)
            step = {k: v.copy() if hasattr(v, "copy") else v for k, v in model.items()}
            step[name][at] += 0.01
            up = loss(step)
            step[name][at] -= 0.02
            assert grad[name][at] == pytest.approx((up - loss(step)) / 0.02, rel=0.05, abs=0.02)
    d_proj = np.zeros((2, len(x) + 1, 3 * toxicity.HIDDEN))
    for s in range(2):
        np.add.at(d_proj[s], both[s].T.ravel(), d_x[:, s].reshape(-1, 3 * toxicity.HIDDEN))
    d_in = (d_proj[:, :-1] @ model["wx"].transpose(0, 2, 1)).sum(0)
    for i, j in ((0, 0), (3, 2), (1, toxicity.INPUTS - 1), (6, toxicity.ODDS)):
        up, down = x.copy(), x.copy()
        up[i, j] += 0.01
        down[i, j] -= 0.01
        assert d_in[i, j] == pytest.approx((loss(model, up) - loss(model, down)) / 0.02, rel=0.05, abs=0.02)


def test_toxicity_learns_and_ignores_held_out_labels(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    got = toxicity.toxicity(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    hold = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    right = ((hold.predicted == 1) == (hold.toxic == 1)).mean()
    assert right >= 0.9
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.toxicity(docs, flipped).toPandas()
    assert np.allclose(got.sort_values("doc_id").score, again.sort_values("doc_id").score)


def test_toxicity_edges(spark, frame, labels):
    docs = frame(EDGES)
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(EDGES) and all(r["score"] == 0 for r in got if r["doc_id"] in (1, 2, 3))
    assert toxicity.toxicity(frame(EMPTY), labels).count() == 0
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0}
    assert toxicity.clean_documents(docs, labels).columns == docs.columns


def test_spans_lie_whole_in_a_window():
    data = np.frombuffer(" ".join(f"w{i}" for i in range(101)).encode(), np.uint8)
    w = toxicity.Words(data, np.array([0, len(data)]))
    place = np.empty(len(w.distinct), np.int64)
    place[w.of] = np.arange(101)
    _, ids = w.windows()
    held = [set(place[i[i >= 0]].tolist()) for i in ids]
    for start in range(101 - 20):
        assert any(h >= set(range(start, start + 21)) for h in held)


def test_fit_sample_takes_one_text_of_a_repeated_id(spark, frame, monkeypatch):
    monkeypatch.setattr(toxicity, "POSITIVES", 2)
    monkeypatch.setattr(toxicity, "NEGATIVES", 2)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, y: seen.append((texts, y.tolist())))
    rows = [(1, f"hot {i:03}") for i in range(200)] + [(2, "bad"), (3, "good"), (4, "fine")]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    for order in (rows, rows[::-1]):
        toxicity.fit_on(frame(order), labels, exclude=None)
    assert seen == [(["hot 000", "bad", "good"], [0, 1, 0])] * 2


# ------------------------------------------------------------------ language
def test_page_parts():
    assert langid.address("https://user@Blog.Example.com:80/x") == ("blog.example.com", "example.com", "com")
    assert langid.address(None) == langid.address("no address") == ("", "", "")
    assert langid.declared_language('<HTML class=x lang="fr-CA">') == "fr"
    assert langid.declared_language("<meta http-equiv='Content-Language' content='de'>") == "de"
    assert langid.page_text("<style>p{}</style>a&amp;b<!-- x --><p>c</p>").split() == ["a&b", "c"]


def plain_identify(pages, names, logp):
    q, text, place, said = [], [], [], []
    for _, url, page in pages:
        data = langid.page_text(page or "").encode()
        raw = np.frombuffer(data, np.uint8)
        grams, first = langid._grams(raw, np.array([0, len(raw)]))
        n = first[1]
        t = logp[:, grams].sum(1) * (min(n, langid.EVIDENCE) / max(n, 1))
        text.append(t)
        q.append(np.exp(t - t.max()) / np.exp(t - t.max()).sum())
        place.append(langid.address(url))
        said.append(langid.declared_language(page or ""))
    q, size, n = np.array(q), len(names), len(pages)
    out = []
    for i, (host, domain, suffix) in enumerate(place):
        base = (q.sum(0) + 1) / (n + size)
        own = lambda k, v: [j for j in range(n) if place[j][k] == v]
        d, h, s = own(1, domain), own(0, host), own(2, suffix)
        prior = (q[d].sum(0) - q[i] + langid.HOST_PRIOR * base) / (len(d) - 1 + langid.HOST_PRIOR)
        prior = (q[h].sum(0) - q[i] + langid.HOST_PRIOR * prior) / (len(h) - 1 + langid.HOST_PRIOR)
        like = (q[s].sum(0) + langid.LABEL_PRIOR * len(s) / n) / (q.sum(0) + langid.LABEL_PRIOR)
        m = [j for j in range(n) if said[j] == said[i]]
        mark = (q[m].sum(0) + langid.LABEL_PRIOR * len(m) / n) / (q.sum(0) + langid.LABEL_PRIOR) if said[i] else 1.0
        z = text[i] + np.log(mark) + langid.SUFFIX_WEIGHT * np.log(like) + np.log(prior)
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        out.append((names[int(p.argmax())], p.max()))
    return out


def test_fusion_equals_plain_version(spark):
    words = {"en": "the of and that with this", "fr": "le la des et que dans", "de": "der die und nicht mit das"}
    docs = spark.createDataFrame([(i, w * 3, k) for i, (k, w) in enumerate(words.items())] + [(9, None, None)],
                                 "doc_id long, text string, lang string")
    rng, pages = np.random.default_rng(4), []
    for i in range(60):
        k = list(words)[i % 3]
        body = " ".join(rng.choice(words[k].split(), int(rng.integers(0, 6))))
        mark = f' lang="{k}"' if i % 4 else ""
        pages.append((i, f"http://h{i % 7}.d{i % 2}.{'com' if i % 5 else 'fr'}/", f"<html{mark}><p>{body}</p></html>"))
    pages += [(60, None, None), (61, "bad", ""), (61, "bad", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    names, logp = langid.language_model(docs)
    want = plain_identify(pages, names, logp)
    got = {r["page_id"]: r for r in langid.identify(df, docs).collect()}
    for (i, *_), (lang, p) in zip(pages, want):
        assert got[i]["lang"] == lang and got[i]["posterior"] == pytest.approx(p, rel=1e-6)
    assert langid.identify(df, docs).count() == len(pages)
    assert langid.identify(df.limit(0), docs).count() == 0
    assert {r["lang"] for r in langid.identify(df, docs.limit(0)).collect()} == {None}


def test_languages_in_blocks_answer_like_one_block(spark):
    """More languages than a task holds at once: read in stored passes, with equal answers."""
    words = {f"l{k:03d}": f"wort{k} satz{k * 7} zahl{k * 13} " for k in range(40)}
    docs = spark.createDataFrame([(i, w * 4, x) for i, (x, w) in enumerate(words.items())], "doc_id long, text string, lang string")
    pages = [(i, f"https://h{i % 3}.example.org/{i}", f"<p>{words[f'l{k:03d}'] * 3}</p>") for i, k in enumerate([0, 7, 15, 16, 39, 7])]
    pages += [(100, None, None), (101, "https://h1.example.org/x", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert len(langid.languages(docs)) == 40
    got = {r["page_id"]: (r["lang"], r["text_lang"], r["posterior"]) for r in langid.identify(df, docs, block=16).collect()}
    one = {r["page_id"]: (r["lang"], r["text_lang"], r["posterior"]) for r in langid.identify(df, docs).collect()}
    assert got == one and len(got) == len(pages)
    assert [got[i][1] for i in range(6)] == ["l000", "l007", "l015", "l016", "l039", "l007"]
    assert got[100][1] is None and got[101][1] is None


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages_decide_on_what_they_get(spark):
    docs = table(spark, SF, "documents")
    sizes, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        sizes.append(docs.count())
        assert docs.join(before, "doc_id", "left_anti").count() == 0
        if name == "simhash_near_dedup":
            assert simhash.links(simhash.fingerprint(docs).select("fp").distinct()).count() == 0
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == docs.count()


def test_pipeline_runs_on_odd_rows(spark, frame):
    docs = frame(EDGES)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.count()
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
