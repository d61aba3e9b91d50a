"""WARC archives, embedding whitening and target resampling against plain versions."""

import base64
import glob
import gzip
import hashlib
import io
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_data import EDGES, EMPTY
from saferow.llm import resampling, warc, whitening
from saferow.llm.common import filesystem, qualified

# ---------------------------------------------------------------------- WARC
PAGES = "page_id long, url string, html string, size int, sha1 string, record_type string"
PAGE_ROWS = [(3, "http://a/x", "<p>é same</p>"), (1, "http://b y\n", "<p>é same</p>"), (2, None, None), (5, "u", ""),
             (4, "http://a/x", "other"), (4, "http://a/x", "other"), (None, "z", "<p>é same</p>"),
             (None, None, "only null id"), (9, "long", "lorem ipsum " * 300_000)]


def pages(spark, rows):
    return spark.createDataFrame([(*r, 7, "s", "t") for r in rows], PAGES)


def plain_warc(rows, least=0):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) by a dictionary of payloads."""
    big = 1 << 62
    out, seen = [], set()
    key = lambda r: (big if r[0] is None else r[0], r[1] is None, r[1] or "")
    first = {}
    for r in sorted(rows, key=key):
        first.setdefault(r[2] or "", r)
    for r in rows:
        body = (r[2] or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        f = first[r[2] or ""]
        again = len(body) >= least and ((r[0], r[1]) != (f[0], f[1]) or (r[2] or "") in seen)
        if not again:
            seen.add(r[2] or "")
        out.append((r[0], len(body), digest, "revisit" if again else "response", f[0] if again else None))
    return sorted(out, key=str)


def answers(df):
    got = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted(map(tuple, got), key=str)


@pytest.mark.parametrize("least", [0, 6])
def test_archives_equal_a_dictionary_of_payloads(spark, tmp_path, least):
    manifest = warc.write_archives(pages(spark, PAGE_ROWS), str(tmp_path), min_bytes=least)
    rows = warc.read_archives(manifest)
    assert answers(rows) == plain_warc(PAGE_ROWS, least)
    assert warc.dangling(rows).isEmpty()
    back = sorted(((r["page_id"], r["html"]) for r in warc.read_pages(manifest).collect()), key=str)
    assert back == sorted(((r[0], r[2] or "") for r in PAGE_ROWS), key=str)


def test_archives_of_an_empty_table(spark, tmp_path):
    manifest = warc.write_archives(pages(spark, []), str(tmp_path))
    assert manifest.isEmpty() and warc.read_archives(manifest).isEmpty()


def test_a_hot_payload_is_stored_once_and_files_are_bounded(spark, tmp_path):
    rows = [(i, f"u{i}", "hot" if i % 3 else f"page {i} " * 40) for i in range(900)]
    manifest = warc.write_archives(pages(spark, rows), str(tmp_path), file_bytes=4000)
    assert answers(warc.read_archives(manifest)) == plain_warc(rows)
    assert manifest.count() > 8 and manifest.agg(F.max("n_bytes")).first()[0] < 4000 + 2000
    assert manifest.agg(F.sum("n_records")).first()[0] == 900
    whole = b"".join(gzip.open(f).read() for f in glob.glob(f"{tmp_path}/*.warc.gz"))
    assert whole.count(b"\r\n\r\nhot\r\n\r\n") == 1  # any gzip reader sees the records one after the other


def archive(*payloads):
    return b"".join(warc.record("response", {"Content-Type": warc.HTTP, "WARC-Payload-Digest": "sha1:" + warc.base32_sha1(p),
                                             "Page-ID": i}, warc.http_head(len(p)) + p) for i, p in enumerate(payloads))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=400), max_size=6), st.integers(1, 50))
def test_reader_gives_back_every_payload_at_any_piece_size(payloads, piece):
    raw = archive(*payloads)
    got = list(warc.RecordReader(io.BytesIO(raw), keep_payload=True, piece=piece))
    assert [r.payload for r in got] == payloads and [r.payload_bytes for r in got] == [len(p) for p in payloads]
    for r in got:  # a record can be read alone, from its offset
        alone = next(iter(warc.RecordReader(io.BytesIO(raw[r.offset:]), keep_payload=True)))
        assert alone.payload == r.payload


def test_reader_refuses_what_does_not_agree():
    good = zlib.decompress(archive(b"some payload"), 31)
    pack = lambda b: gzip.compress(b)
    bad = {"block digest": good.replace(b"some", b"same"), "early": good[:-10], "line ends": good + b"x",
           "Content-Length": re.sub(rb"\r\nContent-Length: \d+\r\n\r\nHTTP", b"\r\n\r\nHTTP", good), "version": b"HTTP/1.1" + good}
    for what, raw in bad.items():
        with pytest.raises(ValueError, match=what):
            list(warc.RecordReader(io.BytesIO(pack(raw))))
    with pytest.raises(ValueError, match="payload digest"):
        raw = warc.record("response", {"Content-Type": warc.HTTP, "WARC-Payload-Digest": "sha1:A"}, warc.http_head(1) + b"x")
        list(warc.RecordReader(io.BytesIO(raw)))
    cut = archive(b"first", b"second payload")
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.RecordReader(io.BytesIO(cut[:-12])))
    broken = bytearray(cut)
    broken[-5] ^= 1  # gzip's own checksum
    with pytest.raises(ValueError):
        list(warc.RecordReader(io.BytesIO(bytes(broken))))


def test_a_missing_record_is_noticed(spark, tmp_path):
    manifest = warc.write_archives(pages(spark, PAGE_ROWS), str(tmp_path))
    more = manifest.withColumn("n_records", F.col("n_records") + 1)
    with pytest.raises(Exception, match="the manifest says"):
        warc.read_archives(more).collect()


def test_folders_are_qualified(spark, tmp_path):
    path = qualified(spark, str(tmp_path))
    assert path.startswith("file:/") and filesystem(path)[1] == str(tmp_path)


# ----------------------------------------------------------------- whitening
VECTORS = "vec_id long, embedding array<float>, x int, label int, n long"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], VECTORS)


def plain_whitening(rows, p):
    good = [(i, [math.floor(64.0 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in good}), np.int64)
    n, s = len(fit), fit.sum(0)
    c = (fit * n - s) / n
    cov = c.T @ c / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:p], q[:, ::-1][:, :p]
    out = {}
    for i, x in good:
        off = np.array(x) * n - s
        out.setdefault(i, []).append((int((off * off).sum()), (off / n) @ q / np.sqrt(e)))
    return n, out, e / np.trace(cov)


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(5)
    basis = rng.standard_normal((40, 40)) * np.geomspace(3, 0.05, 40)
    rows = [(i, [float(v) for v in rng.standard_normal(40) @ basis]) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # a vector that a third of the rows hold
    return rows + [(2000, None), (2001, []), (2002, [float("nan")] * 40), (2003, [None] * 40),
                   (2004, [float("inf")] + [0.0] * 39), (None, rows[3][1]), (5, rows[5][1])]


def test_whitening_equals_a_full_decomposition(spark, cloud):
    got = whitening.whitened(vectors(spark, cloud), components=6, oversample=6).toPandas()
    n, want, share = plain_whitening(cloud, 6)
    assert len(got) == 6 * sum(len(v) for v in want.values()) and set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    sign = None
    for key, part in got.groupby(got["vec_id"].fillna(-1)):
        mine = want[None if key == -1 else int(key)]
        assert len(part) == 6 * len(mine)
        part = part.drop_duplicates("component").sort_values("component")
        assert list(part["component"]) == [1, 2, 3, 4, 5, 6] and {int(d) for d in part["deviation"]} == {mine[0][0]}
        if sign is None:
            sign = np.sign(part["whitened"].to_numpy() * mine[0][1])
        assert np.allclose(part["whitened"].to_numpy() * sign, mine[0][1], atol=1e-9)
        assert np.allclose(part["explained"], share, rtol=1e-9)


def test_the_filter_takes_several_sweeps_and_certifies(spark, cloud):
    rows = whitening.integer_vectors(vectors(spark, cloud))
    basis = whitening.fit_basis(rows, 6, 6)
    assert basis.residual < 1e-12 and basis.passes > whitening.LANCZOS + 2
    assert np.allclose(basis.vectors.T @ basis.vectors, np.eye(6), atol=1e-13)
    assert (np.diff(basis.values) < 0).all()


def test_whitening_with_few_directions_and_edges(spark):
    few = [(i, [float(i % 4), float(i % 4) * 2, 1.0]) for i in range(40)]
    got = whitening.whitened(vectors(spark, few)).toPandas()
    assert set(got["component"]) == {1} and abs(got["explained"].iloc[0] - 1) < 1e-12
    assert whitening.whitened(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).isEmpty()
    assert whitening.whitened(vectors(spark, [])).isEmpty()
    with pytest.raises(ValueError, match="same length"):
        whitening.whitened(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))
    with pytest.raises(Exception, match="beyond"):
        whitening.whitened(vectors(spark, [(1, [1e30, 2.0]), (2, [1.0, 2.0])])).collect()


# ---------------------------------------------------------------- resampling
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {65 + i: 97 + i for i in range(26)}


def plain_features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def plain_resampling(docs, target, buckets=10000, percent=25, least=20):
    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for f in plain_features(t)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out
    s, t = counts(d[1] for d in docs), counts(target)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets))))
            for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        w, f = plain_features(text)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(able):
        r.append(k + 1 if k < percent * len(able) // 100 else None)
    return sorted((tuple(r) if len(r) == 6 else (*r, None) for r in rows), key=str)


def target_frame(spark, texts):
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "item_id long, text string, weight int")


@pytest.mark.parametrize("docs", [EDGES, EMPTY, [(i, f"word{i % 7} The THE é{i} 9 " * (i % 9 + 3)) for i in range(300)]
                                  + [(None, "a b c d e " * 9)] * 40 + [(3, "a b c d e " * 9)] * 40])
def test_resampling_equals_a_plain_version(spark, frame, docs):
    target = ["The word1 a b", None, "", "é5 9 the"]
    got = resampling.resample(frame(docs), target_frame(spark, target))
    assert sorted(map(tuple, got.collect()), key=str) == plain_resampling([r[:2] for r in docs], target)


def test_resampling_towards_an_empty_target(spark, frame):
    docs = [(i, "some words " * 12) for i in range(8)]
    got = resampling.resample(frame(docs), target_frame(spark, []))
    assert sorted(map(tuple, got.collect()), key=str) == plain_resampling(docs, [])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB é9\n.\x00ZİK", max_size=30), max_size=8), st.integers(1, 4))
def test_runs_are_the_runs_of_words(texts, order):
    got = [sorted(zip(doc.tolist(), crc[here].tolist())) for crc, here, doc in resampling.runs(pa.array(texts, pa.string()), order)]
    for k, found in enumerate(got, 1):
        want = []
        for i, t in enumerate(texts):
            w = WORD.findall(t.translate(LOWER))
            want += [(i, zlib.crc32(" ".join(w[j:j + k]).encode())) for j in range(len(w) - k + 1)]
        assert found == sorted(want)


def test_slices_cover_all_rows_whatever_the_limit():
    col = pa.array(["x" * n for n in (5, 0, 30, 2)] + [None, "é" * 9])
    for limit in (1, 7, 1000):
        assert [t for s in resampling.slices(col, limit) for t in s.to_pylist()] == [t or "" for t in col.to_pylist()]
