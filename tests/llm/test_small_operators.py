"""Mixing, token counts, token files, decontamination, quality, SimHash against plain versions."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from saferow.llm import binary, decontam, mixing, quality, simhash, tokens
from saferow.llm.common import scratch, table
from saferow.llm.queries import vocabulary

from llm_data import EDGES, EMPTY

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df, *by):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------------- mixing
def test_mix_keeps_targets_limits_and_reruns(spark, frame):
    rng = np.random.default_rng(3)
    docs = frame([(i, "w " * int(rng.integers(0, 30)), f"s{i % 7 if i % 3 else 0}") for i in range(6000)])
    a = mixing.mix(mixing.units_of(docs), leaf=100).toPandas()
    b = mixing.mix(mixing.units_of(docs.repartition(13)), leaf=100).toPandas()
    key = ["doc_id", "source", "size", "copies"]
    assert a[key].sort_values("doc_id").values.tolist() == b[key].sort_values("doc_id").values.tolist()
    assert a.copies.max() <= 3 and a.copies.min() >= 0
    by = a.assign(taken=a.copies * a["size"] * a.n_rows).groupby("source").agg(
        taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"))
    assert (abs(by.taken - by.target) <= 30).all()  # less than one document
    assert (by.target <= 3 * by["size"] + 1e-6).all()
    assert by.target.sum() == pytest.approx(by["size"].sum())


def test_repeated_rows_come_near_the_target(spark, frame):
    """Equal rows are no block: with a third of all rows under one key, and with null ids, each
    source stays within one document of its target, in the plan and in the rows taken."""
    rows = [(1, "a b c", "s")] * 50 + [(10 + i, "a b c", "s") for i in range(50)]
    rows += [(None, f"x{i} y", "t") for i in range(61)] + [(500 + i, "z " * 7, "u") for i in range(20)]
    rows += [(7, "one two", None), (7, "two one", None), (7, "one two", None)]
    docs = frame(rows)
    plan = mixing.mix(mixing.units_of(docs)).toPandas()
    by = plan.assign(taken=plan.copies * plan["size"] * plan.n_rows).groupby("source", dropna=False).agg(
        taken=("taken", "sum"), target=("target", "first"))
    assert (abs(by.taken - by.target) < 7 + 1e-9).all() and plan.n_rows.sum() == len(rows)
    taken = Counter((r["doc_id"], r["source"]) for r in mixing.mixed_documents(docs).collect())
    want = Counter()
    for r in plan.itertuples():
        source = r.source if isinstance(r.source, str) else None
        want[None if np.isnan(r.doc_id) else int(r.doc_id), source] += int(r.copies * r.n_rows)
    assert taken == +want
    most = Counter(r["text"] for r in mixing.mixed_documents(docs).collect() if r["doc_id"] == 7)
    assert all(most[t] <= 3 * n for t, n in (("one two", 2), ("two one", 1)))


def test_targets_reshare_the_excess(spark):
    units = spark.createDataFrame([(1, "a", 10), (2, "b", 100), (3, "c", 1000), (4, None, 90)],
                                  "doc_id long, source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(
        mixing.mix(units).select("doc_id", "source", "size", "n_rows")).collect()}
    # weights 1, 2, 3, 1 of 1200; a is limited to 30, b to 300, null to 270; c takes the rest
    assert got == pytest.approx({"a": 30.0, "b": 300.0, None: 217.5, "c": 652.5})


def test_mix_edges(frame):
    assert mixing.mix(mixing.units_of(frame(EMPTY))).count() == 0
    got = mixing.mix(mixing.units_of(frame(EDGES))).collect()
    assert sum(r["n_rows"] for r in got) == len(EDGES)
    docs = frame(EDGES)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    plan = Counter()
    for r in got:
        plan[r["doc_id"]] += r["copies"] * r["n_rows"]
    assert Counter(r["doc_id"] for r in out.collect()) == +plan


# ------------------------------------------------------------------- tokens
TEXTS = ["", "hello world", "it's <|endoftext|> isn't  \n\n x\t\t", "naïve café ÆØ 123 ½²", "日本語 テスト 한국", "a" * 300,
         "\x1c\x1d\x1e\x1f odd \x85 spaces  x", "ɐ ʘ \U0001F600 ՘ ⅷ", "x<|endoftext|><|endoftext|>y", "'re 'RE 's"]


def test_counts_and_ids_equal_the_library(spark, frame):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(vocabulary())
    want = {i: lib.encode(t, add_special_tokens=False).ids for i, t in enumerate(TEXTS)}
    docs = frame(list(enumerate(TEXTS)))
    got = {r["doc_id"]: r for r in tokens.count_tokens(docs, vocabulary()).collect()}
    assert {i: r["n_tokens"] for i, r in got.items()} == {i: len(x) for i, x in want.items()}
    assert {i: r["n_bytes"] for i, r in got.items()} == {i: len(t.encode()) for i, t in enumerate(TEXTS)}
    manifest = binary.write_token_files(docs, scratch(spark, "t"), vocabulary(), files=3)
    start = 0
    rows = sorted(binary.read_token_files(manifest).collect(), key=lambda r: r["doc_id"])
    for r in rows:
        ids = np.array(want[r["doc_id"]] + [0], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert [x.tolist() for x in binary.read_document(spark, manifest, 3)] == [want[3] + [0]]


def test_files_stay_bounded_and_a_repeated_row_is_spread(spark, frame):
    rows = [(i, f"text number {i}") for i in range(60)] + [(7, "the same words")] * 200 + [(None, None)] * 30
    path = scratch(spark, "t") + "/docs"
    frame(rows).repartition(4).write.parquet(path)
    manifest = binary.write_token_files(spark.read.parquet(path), scratch(spark, "t"), vocabulary(), files=4, file_ids=64)
    files = manifest.orderBy("file_no").collect()
    assert ":" in files[0]["uri"] and len(files) > 12 and max(f["n_ids"] for f in files) < 64 + 8
    assert [f["base"] for f in files] == list(np.cumsum([0] + [f["n_ids"] for f in files])[:-1])
    assert max(sum(f["n_docs"] for f in files if f["file_no"] >> 32 == p) for p in range(4)) < 200
    got = sorted(binary.read_token_files(manifest).collect(), key=lambda r: r["start"])
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    assert [r["start"] for r in got] == list(np.cumsum([0] + [r["n_tokens"] for r in got])[:-1])
    assert [r["doc_id"] for r in got[:30]] == [None] * 30
    assert len(binary.read_document(spark, manifest, 7)) == 201 and binary.read_document(spark, manifest, 999) == []


def test_token_edges(spark, frame):
    assert tokens.count_tokens(frame(EMPTY), vocabulary()).count() == 0
    got = rows_of(tokens.count_tokens(frame(EDGES), vocabulary()))
    assert len(got) == len(EDGES) and (1, 0, 0, False) in got and got.count((5, 3, 2, False)) == 2
    assert binary.read_token_files(binary.write_token_files(frame(EMPTY), scratch(spark, "t"), vocabulary())).count() == 0
    files = binary.read_token_files(binary.write_token_files(frame(EDGES), scratch(spark, "t"), vocabulary())).collect()
    assert len(files) == len(EDGES)
    assert sorted(files, key=lambda r: r["start"])[0]["doc_id"] is None  # null ids first


def test_damaged_frame_is_noticed(tmp_path):
    path = tmp_path / "f.zst"
    with open(path, "wb") as f:
        w = binary.FrameWriter(f, "<u2")
        for i in range(3):
            w.add(i, np.arange(100 * (i + 1), dtype="<u2").tobytes())
        w.close()
    raw = bytearray(path.read_bytes())
    with open(path, "rb") as f:
        reader = binary.FrameReader(f)
        assert [len(reader.ids(k)) for k in (2, 0, 1)] == [300, 100, 200]
        at = int(reader.at[-2]) + 4 + 8
    size = len(raw)
    raw[size - 9 - 12 * 4 + 8] ^= 1  # the first frame's checksum
    path.write_bytes(raw)
    with open(path, "rb") as f, pytest.raises(ValueError):
        binary.FrameReader(f).ids(0)
    assert at < size


# ----------------------------------------------------------- decontamination
def test_phrases_edges_and_proximity(spark, frame):
    item = "one two three four five six seven eight nine ten eleven"
    docs = frame([*EDGES, (20, f"x {item.upper()}, y"), (21, "ONE two three four five six seven eight nine ten"),
                  (22, "one two three four five six seven eight nine"), (23, "tiny ITEM here"), (24, item + " " + item)])
    items = spark.createDataFrame([(7, item), (8, "tiny item"), (9, None), (10, ""), (8, "tiny item"), (None, "no id")],
                                  "item_id long, text string")
    got = {}
    for r in decontam.contamination(docs, items).collect():
        got.setdefault(r["doc_id"], (r["n_words"], r["n_hit"], r["n_items"]))
    assert got[20] == (13, 11, 1) and got[21] == (10, 10, 1) and got[22] == (9, 0, 0) and got[23] == (3, 2, 1)
    assert got[24] == (22, 22, 1) and got[None] == (3, 2, 1) and got[1] == (0, 0, 0)
    assert decontam.contamination(frame(EMPTY), items).count() == 0
    assert decontam.contamination(docs, items.limit(0)).where("contaminated").count() == 0
    kept = decontam.clean_documents(docs, items)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 5, 6, 7, 22}
    index = decontam.build_index(docs)
    near = decontam.proximity_matches(index, {"q": ["ten", "one"], "no": ["tiny", "ten"]}, slop=10)
    ids = decontam.indexed_documents(index)
    assert {(r["query"], r["doc_id"]) for r in near.join(ids, ["segment", "doc_no"]).collect()} == {
        ("q", 20), ("q", 21), ("q", 24)}


def test_items_in_many_blocks_give_the_same_spans(spark, frame):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 40, rng.integers(1, 60))) for _ in range(12)]
    items = [(k % 9 if k % 4 else None, t) for k, t in enumerate(texts)] + [(3, "w1 w2"), (3, texts[4]), (77, texts[4])]
    docs = [(i, f"w0 {texts[i % 12]} w1 w2 {texts[(i * 5) % 12]}") for i in range(30)]
    index = decontam.build_index(frame(docs).repartition(3))
    ids = decontam.indexed_documents(index)
    want, by_item = set(), {}
    for name, t in items:
        w = t.split()
        size = min(10, len(w))
        by_item.setdefault("null" if name is None else str(name), set()).update(
            tuple(w[k:k + size]) for k in range(len(w) - size + 1))
    for i, t in docs:
        w = t.split()
        for name, windows in by_item.items():
            runs = []
            for a, b in sorted((k, k + len(x)) for x in windows for k in range(len(w)) if tuple(w[k:k + len(x)]) == x):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            want.update((i, name, a, b) for a, b in runs)
    table = spark.createDataFrame(items, "item_id long, text string")
    for block_words in (7, 1 << 18):
        got = decontam.phrase_spans(index, table, block_words).join(ids, ["segment", "doc_no"])
        rows = [(r["doc_id"], r["item"], r["start"], r["end"]) for r in got.collect()]
        assert len(rows) == len(want) and set(rows) == want


# ------------------------------------------------------------------- quality
def plain_quality(text):
    w = SPACE_WORD.findall(text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if SPACE_WORD.search(x):
            dup += x in seen
            seen.add(x)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = {i + j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside)


def test_quality_counts_and_edges(spark, frame, labels):
    texts = ["a b c d e f a b c d e x\na b\n\n \na b\na b c", "é# $x\ty|z\n\n", "same same same same same same same"]
    docs = frame([*EDGES, *[(100 + i, t) for i, t in enumerate(texts)]])
    got = quality.quality(docs, labels).collect()
    want = Counter((r[0], *plain_quality(r[1])) for r in [*EDGES, *[(100 + i, t) for i, t in enumerate(texts)]])
    assert Counter(tuple(r)[:6] for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality.quality(frame(EMPTY), labels).count() == 0
    alone = quality.quality(docs, labels.limit(0)).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in alone)


def test_quality_threshold_is_the_quantile_of_all_good_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "TRUSTED_ROWS", 100)
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    got = quality.quality(table(spark, "/root/testdata/sf0.01", "documents"), labels).toPandas()
    good = {r[0] for r in labels.where("quality = 1").select("doc_id").collect()}
    assert len(good) > 100
    at = np.quantile(got.score[got.doc_id.isin(good)], quality.TRUSTED_QUANTILE)
    clear = (got.score - at).abs() > 1e-9
    assert (got.kept == (~got.base_failed & (got.score >= at)))[clear].all()


def test_quality_counts_every_good_row_as_trusted(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{i} good text " * 5 + "xyz" * (i % 7)) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 40), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    trusted, raw = quality.corpus_counts(docs.withColumn("trusted", F.col("doc_id") < 40))
    ratio = quality.log_ratio(trusted, raw)
    want = {r["doc_id"]: r["score"] for r in quality.scored(docs.withColumn("trusted", F.lit(True)), ratio).collect()}
    for most in (3, 1000):
        monkeypatch.setattr(quality, "TRUSTED_ROWS", most)
        got = {r["doc_id"]: r["score"] for r in quality.quality(docs, labels).collect()}
        assert got == pytest.approx(want)


# ------------------------------------------------------------------- SimHash
def plain_fingerprint(text):
    w = SPACE_WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum((2 * sum(v >> b & 1 for v in h) > len(h)) << b for b in range(64))


def test_fingerprints_and_components(frame):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here " * 8
    near = [(100 + i, base + f"tail {i}") for i in range(30)]
    docs = frame([*EDGES, *near])
    got = simhash.near_duplicates(docs).collect()
    rows = [*EDGES, *near]
    fp = [plain_fingerprint(r[1]) for r in rows]
    assert Counter((r["doc_id"], r["fp"] % (1 << 64)) for r in got) == Counter((r[0], f) for r, f in zip(rows, fp))
    root = list(range(len(rows)))
    for _ in rows:  # plain closure
        for i in range(len(rows)):
            for j in range(len(rows)):
                if bin(fp[i] ^ fp[j]).count("1") <= 3:
                    root[i] = root[j] = min(root[i], root[j])
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root[i]] = min(low.get(root[i], r[0]), r[0])
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter(
        (r[0], low.get(root[i])) for i, r in enumerate(rows))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))
    assert simhash.near_duplicates(frame(EMPTY)).count() == 0


def test_links_equal_brute_force_also_when_groups_are_divided(spark):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = {int(s) ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for s in seeds for a, b, c in rng.integers(0, 64, (25, 3))}
    fps = sorted(f - (1 << 64) if f >= 1 << 63 else f for f in fps)
    v = np.array(fps, np.int64).view(np.uint64)
    root = list(range(len(v)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= 3):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    want = {f: fps[find(i)] for i, f in enumerate(fps)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for group in (50_000, 4):
        got = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, max_group=group)).collect()}
        assert {f: got.get(f, f) for f in fps} == want
