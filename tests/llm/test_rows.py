"""Url filters, the Merkle manifest and periodic runs: against plain versions and SQL."""

import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from edges import CLASHES, LONG, SF, TEXTS, documents
from oracle import TABLES, compare
from pyspark.sql import functions as F

from tidemark.llm import hosts, merkle, queries, runs


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def saved(df, folder, name):
    """A folder of tables in which ``name`` is ``df`` and the others are the smallest given ones."""
    for other in TABLES:
        if other != name:
            os.symlink(f"{SF}/{other}.parquet", folder / f"{other}.parquet")
    # one file, as DuckDB's views read one file
    pq.write_table(df.toArrow(), folder / f"{name}.parquet")
    return str(folder)


# --- periodic runs


def brute_runs(words, least=6, repeats=4):
    """All maximal stretches of a smallest period, by comparing all words a period apart."""
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j + q - i
            if length >= max(least, repeats * q):
                part = words[start : start + length]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    found[(start, q)] = length
            i = j
    return [(s, found[(s, q)], q) for s, q in sorted(found)]


def brute_collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def ascii_words(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_runs_by_brute_force():
    rng = random.Random(5)
    texts = []
    for _ in range(400):
        base = [rng.choice("ab" if rng.random() < 0.5 else "abcd") for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.7:
            stretch = [rng.choice("abc") for _ in range(rng.randrange(1, 12))] * rng.randrange(1, 9)
            at = rng.randrange(len(base) + 1)
            base[at:at] = stretch[: len(stretch) - rng.randrange(3)]
        texts.append(base)
    sizes = np.array([len(t) for t in texts])
    codes = np.array([ord(w) for t in texts for w in t])
    for least, repeats in ((6, 4), (1, 3), (9, 5)):
        low, high, step = runs.runs_of(codes, sizes, least, repeats)
        begins = np.cumsum(sizes) - sizes
        want = [(int(b) + s, int(b) + s + n, q) for b, t in zip(begins, texts, strict=True) for s, n, q in brute_runs(t, least, repeats)]
        assert list(zip(low.tolist(), high.tolist(), step.tolist(), strict=True)) == want and want


def with_tail(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected_runs(doc_id, text):
    words = with_tail(doc_id, ascii_words(text))
    found = brute_runs(words)
    best = None
    for s, n, q in found:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    one = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *one, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(brute_collapsed(words, found)))


def test_runs_of_the_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op13_periodic_runs(spark, SF).collect()
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in rows}
    assert len(rows) == len(texts) and got == {d: expected_runs(d, t) for d, t in texts.items()}
    assert any(v[0] for v in got.values())


def test_runs_edges(spark, tmp_path):
    rows = [*TEXTS, (9, "x " * 9), (10, "a b c " * 5 + " "), (11, "p q p q p q p q p q r r r r r r")]
    found = runs.find_runs(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    want = sorted((str(i), str(brute_runs(ascii_words(t))), sha(brute_collapsed(ascii_words(t), brute_runs(ascii_words(t))))) for i, t in rows if t != LONG)
    got = sorted((str(r.doc_id), str([tuple(x) for x in r.runs]), sha(r.collapsed)) for r in found if r.doc_id != 6)
    assert got == want
    long = next(r for r in found if r.doc_id == 6)
    assert [tuple(x) for x in long.runs] == [(0, 80_000, 4)] and long.collapsed == "wort und andere worte"
    assert runs.find_runs(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(documents(spark), repeats=2)
    folder = saved(documents(spark, rows), tmp_path, "documents")
    for r in queries.op13_periodic_runs(spark, folder).collect():
        if r.doc_id not in (None, 6):
            text = next(t for i, t in rows if i == r.doc_id)
            assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == expected_runs(r.doc_id, text)


# --- Merkle manifest


def test_manifest_against_sql(spark):
    assert compare(spark, SF, queries.op12_manifest, queries.SQL["op12_manifest"]) == ""


def test_manifest_edges_against_sql(spark, tmp_path):
    rows = [(i, t) for i, t in TEXTS if t != LONG] + [(100 + i, f"text {i}") for i in range(70)] + [(7, "once more"), (50, None)]
    langs = F.when(F.col("doc_id") > 160, "zz").when(F.col("doc_id") == 100, "alone").when(F.col("doc_id") > 130, "é").otherwise(F.col("lang"))
    docs = documents(spark, rows).withColumn("lang", langs).coalesce(1)
    folder = saved(docs, tmp_path, "documents")
    assert compare(spark, folder, queries.op12_manifest, queries.SQL["op12_manifest"]) == ""


def test_manifest_over_several_blocks(spark, tmp_path):
    n = 2**merkle.BLOCK_LEVELS + 905
    docs = spark.range(n + 3).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < n, "one").otherwise("two").alias("lang"),
        F.lit(None).cast("string").alias("source"), F.lit(1).cast("long").alias("n_chars"),
    )
    folder = saved(docs, tmp_path, "documents")
    assert compare(spark, folder, queries.op12_manifest, queries.SQL["op12_manifest"]) == ""


@pytest.mark.parametrize("rows", [[(5, "only one")], [(5, "a"), (5, "a")], []])
def test_manifest_of_few_rows(spark, rows):
    docs = documents(spark, rows)
    found = merkle.with_proofs(merkle.manifest(docs, ["doc_id", "text", "rank"], extra={"path_": F.col("rank")})).collect()
    leaf = [sha("".join(f"{len(str(v))}:{v}" for v in (i, t, "x"))) for i, t in rows]
    assert [r.leaf for r in found] == leaf
    root = None if not rows else leaf[0] if len(rows) == 1 else sha(leaf[0] * 2)
    for r in found:
        assert (r.subroot, r.root, r.folded_root, r.path_) == (root, root, root, "x")
        assert r.proof_sha256 == sha("".join(leaf[1:]))


# --- url filters


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[at:]
    end = next((i for i, c in enumerate(path) if c in "?#"), len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at]), path[:end]


def brute_rule(host, path, rules):
    fits = [(len(h + p), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute_scores(pages, rules, links):
    """Mass by host and side, over lists of pages' hosts and actions and of links."""
    total = {}
    for side, action in (("trust", "allow"), ("distrust", "block")):
        edges = {(a, b) if side == "trust" else (b, a) for a, b in links if a and a != b}
        mass = {}
        for host in {h for h, _ in pages}:
            own = [x for h, x in pages if h == host]
            seed = own.count(action) * hosts.UNIT // len(own)
            if seed * 15 // 100:
                mass[host] = seed * 15 // 100
        score = dict(mass)
        for _ in range(hosts.ROUNDS):
            new = {}
            for a, b in edges:
                share = mass.get(a, 0) * 85 // 100 // sum(x == a for x, _ in edges)
                if share:
                    new[b] = new.get(b, 0) + share
            for host, m in new.items():
                score[host] = score.get(host, 0) + m
            mass = new
        total[side] = score
    return total


URLS = [
    "http://a.com/x", "https://www.example.com/en/1?q#f", "http://example.com/en/", "http://EXAMPLE.com/de/1", "http://sub.www.example.com/en",
    "http://s.net/es/1", "http://s.net/fr/", "http://s.net/en/1", "http://t.net/en/1", "http://t.net/es/1", "http://t.net/de/1", "http://hub.org/1",
    "http://fan.org/", "http://fan2.org/a", "no scheme", "", None, "http://com", "com://com/", "http:///es/1", "http://x.org?u=http://s.net/es/1", "ftp://notcom/1",
    "http://user@a.com:80/", "http://s.net/es/1", "http://cÉ.net/fr/é\n2", "http://bad.net/es/1",
]
LINKS = {
    "http://hub.org/1": ["http://a.com/", "//s.net/es/9", "/own", "http://hub.org/2", "https://T.NET"],
    "http://fan.org/": ["http://bad.net/es/1", "http://BAD.net/es/1", "http://s.net/es/1"],
    "http://fan2.org/a": ["http://a.com/x", "http://s.net/"],
    "http://a.com/x": ["http://hub.org/"],
    "http://s.net/en/1": ["http://fan.org/x", "http://unseen.org/"],
}


def url_pages(spark):
    def html(url):
        return "".join(f"<p><A class='k' href = '{x}'>t</a>" for x in LINKS.get(url, [])) + "<a name=x><link href='http://no.org/'>"

    rows = [(i, u, html(u)) for i, u in enumerate(URLS)] + [(None, "http://fan.org/", None), (0, "http://a.com/x", html("http://a.com/x"))]
    rows = [(*r, *["x"] * len(CLASHES), "h", "p", "r", "s") for r in rows]
    more = ", ".join(f"`{c}` string" for c in (*CLASHES, "host", "path", "rule", "salt"))
    return spark.createDataFrame(rows, f"page_id long, url string, html string, {more}"), rows


def test_url_verdicts_by_brute_force(spark, tmp_path):
    pages, rows = url_pages(spark)
    split = [brute_url(u) for _, u, *_ in rows]
    fits = [brute_rule(h, p, queries.URL_RULES) for h, p in split]
    links = [(h, brute_url(x if "://" in x else "http:" + x)[0]) for (_, u, body, *_), (h, _) in zip(rows, split, strict=True) if body for x in LINKS.get(u, []) if x[:1] != "/" or x[:2] == "//"]
    score = brute_scores([(h, a) for (h, _), (_, a) in zip(split, fits, strict=True)], queries.URL_RULES, links)
    want = []
    for (i, *_), (h, p), (rule, action) in zip(rows, split, fits, strict=True):
        t, d = score["trust"].get(h, 0), score["distrust"].get(h, 0)
        verdict = action or ("block" if d >= hosts.THRESHOLD and d > t else "allow")
        want.append((str(i), h, p, rule, verdict, t, d))
    folder = saved(pages, tmp_path, "pages")
    got = [(str(r.page_id), *list(r)[1:]) for r in queries.op11_url_filter(spark, folder).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    verdicts = {h: v for _, h, _, rule, v, *_ in want if rule is None}
    assert verdicts["fan.org"] == "block" and verdicts["s.net"] == "block" and verdicts["fan2.org"] == "block" and verdicts["x.org"] == "allow"
    assert compare(spark, folder, queries.op11_url_filter, queries.SQL["op11_url_filter"]) == ""
    rules = spark.createDataFrame(queries.URL_RULES, "action string, host string, path string")
    kept = hosts.keep_allowed(pages, rules)
    assert kept.columns == pages.columns and kept.count() == sum(w[4] == "allow" for w in want)


def test_url_filter_on_the_given_pages(spark):
    assert compare(spark, SF, queries.op11_url_filter, queries.SQL["op11_url_filter"]) == ""


def test_url_filter_edges(spark):
    rules = spark.createDataFrame(queries.URL_RULES, "action string, host string, path string")
    pages, rows = url_pages(spark)
    assert hosts.url_verdicts(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in hosts.url_verdicts(pages, rules.limit(0)).collect()} == {"allow"}
    long = "http://" + "a." * 100_000 + "com/" + "p" * 100_000
    big = spark.createDataFrame([(1, long, "<a " * 200_000 + "href=" + " " * 200_000)], "page_id long, url string, html string")
    assert [(r.rule, r.verdict) for r in hosts.url_verdicts(big, rules).collect()] == [("com/", "allow")]


def test_a_host_with_many_links(spark):
    edges = spark.range(3000).select(F.lit("trust").alias("side"), F.lit("hub").alias("src"), F.concat(F.lit("h"), F.col("id")).alias("dst"))
    seeds = spark.createDataFrame([("trust", "hub", hosts.UNIT)], "side string, host string, mass long")
    found = {r.host: r.mass for r in hosts.spread(seeds, edges).collect()}
    share = hosts.UNIT * 15 // 100 * 85 // 100 // 3000
    assert found == {f"h{i}": share for i in range(3000)} | {"hub": hosts.UNIT * 15 // 100}
