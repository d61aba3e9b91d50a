"""Language identification of web pages by Bayesian evidence fusion.

Evidence of a page, for every language of the labelled documents:

* its text: hashed byte n-gram multinomials, counted over all labelled documents;
  neighbouring n-grams overlap, so the likelihood is tempered to that of at most
  ``EVIDENCE`` n-grams;
* the language its markup declares: P(declared | language);
* the suffix of its address: P(suffix | language);
* its host: the share of each language among the other pages of the host, smoothed
  towards the same of its domain, and that towards all pages.

The last three are estimated from the pages themselves, weighted by what their
text says (grouped sums); a page's own text is left out of its host's and
domain's sums, so no evidence counts twice.  Pages are joined with one row per
host and one per declared language; a host that holds a third of all pages meets
only partial sums and a join whose large partitions Spark can split.

Defined results: a null or empty page has no text evidence; a missing declaration
gives none; a null or malformed address is one host named ""; ties go to the
first language in order; without labelled documents the language is null;
repeated rows are pages of their own.  Any number of languages is scored: a task
holds the model of ``BLOCK`` of them, and more are read in stored passes.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saferow.llm.common import LOWER, chunks, stored

NGRAM, BUCKETS = 4, 1 << 16
EVIDENCE = 40.0
HOST_PRIOR, LABEL_PRIOR = 5.0, 2.0
SUFFIX_WEIGHT = 0.5
#: Languages whose model a task holds at once; more are read in as many stored passes.
BLOCK = 256
_HIDDEN = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_LANG = re.compile(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,8})")
_META = re.compile(r"(?is)<meta\b[^>]*content-language[^>]*?content\s*=\s*[\"']?\s*([a-z]{2,8})")
_HOST = re.compile(r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


def page_text(page: str) -> str:
    return html.unescape(_HIDDEN.sub(" ", page))


def declared_language(page: str) -> str | None:
    found = _LANG.search(page) or _META.search(page)
    return found.group(1).lower() if found else None


def address(url: str | None) -> tuple[str, str, str]:
    """(host, domain of two labels, suffix)."""
    found = _HOST.match(url or "")
    host = found.group(1).lower().strip(".") if found else ""
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1]


def _grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[data]
    n = len(data) - NGRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    v = np.zeros(n, np.uint32)
    for j in range(NGRAM):
        v = v * np.uint32(0x01000193) + data[j:j + n]
    v = (v ^ (v >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    ok = np.ones(n, bool)
    for j in range(1, NGRAM):
        at = off[1:-1] - j
        ok[at[(at >= 0) & (at < n)]] = False
    return (v[ok] >> np.uint32(16)).astype(np.int64), np.concatenate([[0], np.cumsum(ok)])[np.minimum(off, n)]


def languages(docs: DataFrame) -> list[str]:
    """The languages that labels name, in order: as many as the label set has."""
    return sorted(r[0] for r in docs.where("lang is not null").select("lang").distinct().collect())


def language_model(docs: DataFrame, names: list[str] | None = None) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities by language and bucket) over all documents labelled as
    one of ``names`` (all languages by default)."""
    names = languages(docs) if names is None else names
    number = {x: k for k, x in enumerate(names)}

    def run(batches):
        total = np.zeros((len(names), BUCKETS), np.int64)
        for b in batches:
            of = np.array([number[x] for x in b.column("lang").to_pylist()], np.int64)
            for lo, hi, data, off in chunks(b.column("text")):
                grams, first = _grams(data, off)
                cell = np.repeat(of[lo:hi], np.diff(first)) * BUCKETS + grams
                total += np.bincount(cell, minlength=total.size).reshape(total.shape)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["cell", "n"])

    count = np.zeros(len(names) * BUCKETS)
    got = docs.where(F.col("lang").isin(names)).select("lang", "text").mapInArrow(run, "cell long, n long")
    for cell, n in got.groupBy("cell").agg(F.sum("n")).collect():  # at most len(names) * BUCKETS rows
        count[cell] = n
    count = count.reshape(len(names), BUCKETS)
    return names, np.log(count + 0.5) - np.log(count.sum(1, keepdims=True) + 0.5 * BUCKETS)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def page_evidence(pages: DataFrame, docs: DataFrame, names: list[str], block: int = BLOCK) -> DataFrame:
    """page_id, host, domain, suffix, declared, text (tempered log-likelihoods), q
    (what the text alone says); one pass for each ``block`` languages, no shuffle."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                        F.array().cast("array<double>").alias("text"))
    for first in range(0, len(names), block):
        _, logp = language_model(docs, names[first:first + block])
        rows = _evidence_pass(rows, logp, first + block >= len(names))
    return rows


def _evidence_pass(rows: DataFrame, logp: np.ndarray, last: bool) -> DataFrame:
    """``rows`` (page_id, url, html, text) with the likelihoods of more languages behind ``text``: stored,
    or after the last of them the evidence."""
    shared = rows.sparkSession.sparkContext.broadcast(logp)

    def like(b, page):
        logp_rows = shared.value
        out = np.zeros((len(page), len(logp_rows)))
        for lo, hi, data, off in chunks(pa.array([page_text(p or "") for p in page], pa.string())):
            grams, start = _grams(data, off)
            n = np.diff(start)
            full = np.flatnonzero(n)
            for k in range(len(logp_rows)):
                if len(full):
                    out[lo + full, k] = np.add.reduceat(logp_rows[k][grams], start[full])
            out[lo:hi] *= (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None]
        before = np.array(b.column("text").to_pylist(), float).reshape(len(page), -1)
        return np.hstack([before, out])

    def more(batches):
        for b in batches:
            if b.num_rows:
                text = like(b, b.column("html").to_pylist())
                yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), b.column("html"),
                                                  pa.array(list(text), pa.list_(pa.float64()))], ["page_id", "url", "html", "text"])

    def final(batches):
        for b in batches:
            if not b.num_rows:
                continue
            page, url = b.column("html").to_pylist(), b.column("url").to_pylist()
            place = list(zip(*[address(u) for u in url]))
            said = [declared_language(p or "") for p in page]
            text = like(b, page)
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), *[pa.array(p, pa.string()) for p in place], pa.array(said, pa.string()),
                 pa.array(list(text), pa.list_(pa.float64())), pa.array(list(_softmax(text)), pa.list_(pa.float64()))],
                ["page_id", "host", "domain", "suffix", "declared", "text", "q"])

    if not last:
        return stored(rows.mapInArrow(more, "page_id long, url string, html string, text array<double>"), "page-likelihoods")
    return rows.mapInArrow(final, "page_id long, host string, domain string, suffix string, declared string, "
                                  "text array<double>, q array<double>")


def identify(pages: DataFrame, docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """page_id, host, declared, text_lang, lang and its posterior of every page."""
    names = languages(docs)
    size = len(names)
    if not size:
        return pages.select(F.col("page_id").cast("long").alias("page_id"), *[
            F.lit(None).cast("string").alias(c) for c in ("host", "declared", "text_lang", "lang")],
            F.lit(None).cast("double").alias("posterior"))
    seen = stored(page_evidence(pages, docs, names, block), "page-evidence")
    # q is summed in units of 2**-40, so sums do not depend on the order of rows
    unit = float(1 << 40)
    sums = F.array(*[F.sum(F.round(F.col("q")[k] * unit).cast("long").cast("decimal(38,0)")) for k in range(size)])
    in_all = [F.transform(sums, lambda x: x.cast("double") / F.lit(unit)).alias("s"), F.count(F.lit(1)).alias("n")]
    hosts = stored(seen.groupBy("host", "domain", "suffix").agg(*in_all), "hosts")

    def rolled(*by):
        cols = F.array(*[F.sum(F.round(F.col("s")[k] * unit).cast("decimal(38,0)")).cast("double") / F.lit(unit)
                         for k in range(size)])
        return hosts.groupBy(*by).agg(cols.alias("s"), F.sum("n").alias("n"))

    total = rolled().first()
    if total["n"] is None:
        total = {"s": [0.0] * size, "n": 0}
    all_s, all_n = np.array(total["s"], float), float(total["n"])
    domains = rolled("domain").select("domain", F.col("s").alias("domain_s"), F.col("n").alias("domain_n"))
    suffixes = rolled("suffix").select("suffix", F.col("s").alias("suffix_s"), F.col("n").alias("suffix_n"))
    hosts = hosts.join(domains, "domain").join(suffixes, "suffix").drop("domain", "suffix") \
        .withColumnsRenamed({"s": "host_s", "n": "host_n"})
    said = seen.where("declared is not null").groupBy("declared").agg(*in_all) \
        .select("declared", F.col("s").alias("said_s"), F.col("n").alias("said_n"))
    rows = seen.select("page_id", "host", "declared", "text", "q").join(stored(hosts, "host-sums"), "host") \
        .join(stored(said, "declared-sums"), "declared", "left")

    def fuse(batches):
        base = (all_s + 1) / (all_n + size)
        for b in batches:
            if not b.num_rows:
                continue

            def matrix(c):
                return np.array([x if x is not None else [0.0] * size for x in b.column(c).to_pylist()])

            def column(c):
                return np.array([x or 0 for x in b.column(c).to_pylist()], float)[:, None]

            q = matrix("q")
            domain = (np.maximum(matrix("domain_s") - q, 0) + HOST_PRIOR * base) / (column("domain_n") - 1 + HOST_PRIOR)
            host = (np.maximum(matrix("host_s") - q, 0) + HOST_PRIOR * domain) / (column("host_n") - 1 + HOST_PRIOR)
            # P(value | language): weighted count of pages of the language with the value
            suffix = (matrix("suffix_s") + LABEL_PRIOR * column("suffix_n") / max(all_n, 1)) / (all_s + LABEL_PRIOR)
            said_n = column("said_n")
            mark = (matrix("said_s") + LABEL_PRIOR * said_n / max(all_n, 1)) / (all_s + LABEL_PRIOR)
            mark = np.where(said_n > 0, mark, 1.0)
            text = matrix("text")
            score = text + np.log(mark) + SUFFIX_WEIGHT * np.log(suffix) + np.log(host)
            p = _softmax(score)
            best = p.argmax(1)
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("host"), b.column("declared"),
                 pa.array([names[k] if t.any() else None for k, t in zip(text.argmax(1), text)], pa.string()),
                 pa.array([names[k] for k in best]), pa.array(p[np.arange(len(p)), best])],
                ["page_id", "host", "declared", "text_lang", "lang", "posterior"])

    return rows.mapInArrow(fuse, "page_id long, host string, declared string, text_lang string, lang string, posterior double")
