"""Alignment, url aliases and centroids against brute force on small fixtures."""

import collections
import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabweave.llm import aliases, alignment, centroids

TOKENIZERS = "/opt/tokenizers"
LABELS = "doc_id long, text string, segment int, chunk string, pairs string"


@pytest.fixture(scope="module")
def pair():
    if not os.path.isdir(TOKENIZERS):
        pytest.skip("no tokenizers here")
    return alignment.Pair(f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


def brute_alignment(pair, texts):
    """Whole texts at once; the bytes of pieces and tokens spelled out from the files, not through the operator."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in shown}
    to_byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    out, counts = [], collections.Counter()
    for text in texts:
        if not text:
            out.append(None)
            continue
        encoding, second = pair.first.encode(" " + text, add_special_tokens=False), pair.second.encode(text)
        one = [bytes(to_byte[c] for c in t) for t in encoding.tokens]
        two = [bytes([int(pair.second.id_to_piece(i)[3:5], 16)]) if pair.second.is_byte(i) else pair.second.id_to_piece(i).replace("▁", " ").encode() for i in second]
        if b"".join(one) != (" " + text).encode() or b"".join(two) != (" " + text).encode():
            out.append(None)
            continue
        ends = [list(np.cumsum([len(x) for x in side])) for side in (one, two)]
        groups, at = [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            to = [side.index(end) + 1 for side in ends]
            groups.append((encoding.ids[at[0]:to[0]], second[at[1]:to[1]]))
            at = to
        links = [(a, b) for x, y in groups for a in x for b in y]
        counts.update(set(links))
        out.append((len(one), len(two), len(groups), links, ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else (*r[:3], len(r[3]), sum(counts[x] == most[x[0]] for x in r[3]), sum(counts[x] for x in r[3]), r[4]) for r in out]


def odd_texts():
    rng = random.Random(5)
    parts = ["the", " ", "  ", "\n", "\n\n", "\t", "\r", "\r\n", ";\r\n", ");\r", "\x0b", "\x0c", "\x1c", "\x1f ", " ", "   ", "　 ", " ", "▁", "<s>", "<|endoftext|>", "it's", "'S", "1234", "été", "日本語", "🙂", "é", "\x00", "a" * 90, "}\r\n\r\n{", "--", "ﬁ"]
    fixed = [None, "", " ", "   ", "\n", "\n ", " \n", "foo  bar \n baz ", "a▁b", "\r", "x\r", "x \r y", "word " * 3000, "z" * 20000]
    return fixed + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(300)]


def test_alignment(spark, pair):
    texts = odd_texts() + odd_texts()[:40]  # some repeat
    ids = [i if i % 50 else None for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, n, "c", "p") for n, (i, t) in enumerate(zip(ids, texts, strict=True))], LABELS).repartition(3)
    want = sorted(((i, *row) for i, row in zip(ids, brute_alignment(pair, texts), strict=True)), key=str)
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    for chunk in (1 << 22, 500):
        got = sorted(((r.doc_id, *(r[c] for c in columns), r.groups) for r in alignment.alignments(docs, pair, chunk=chunk).collect()), key=str)
        assert got == want
    hashed = sorted(((r.doc_id, r.n_a, r.groups_sha256) for r in alignment.alignments(docs, pair, digest=True).collect()), key=str)
    assert hashed == sorted(((w[0], w[1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for w in want), key=str)
    assert alignment.alignments(docs.limit(0), pair).collect() == []


def test_cuts_are_verified(pair):
    assert " " in pair.cuts and "\n" in pair.cuts
    assert "\r" not in pair.cuts  # pieces such as ';\r' exist
    for text in (t for t in odd_texts() if t and "▁" not in t):  # that sign stands for a space, its texts are not given back
        segments = pair.segments(text)
        assert "".join(segments) == " " + text
        joined = [sum(x, []) for x in zip(*pair.encoded(segments), strict=True)]
        assert joined == [pair.first.encode(" " + text, add_special_tokens=False).ids, pair.second.encode(text)]


PAGES = "page_id long, url string, html string, node string, alias string, rule int"


def brute_verdicts(rows):
    def place(url):
        if not url or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:end].lower(), rest[end:]
        return host, rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]

    def rule(url):
        host, path = place(url)
        fits = [r for r in aliases.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: len(str(r)), default=None)

    def key(url):
        scheme, rest = url.split("#")[0].split("://", 1)
        return scheme.lower() + "://" + place(url)[0] + rest[len(place(url)[0]):]

    links = collections.defaultdict(set)
    bad = set()
    for _, url, html in rows:
        if url and "://" in url and html:
            for to in aliases.targets(url, html):
                links[key(url)].add(key(to))
                links[key(to)].add(key(url))
                bad |= {key(u) for u in (url, to) if rule(u) and rule(u).verdict == "block"}
    todo = list(bad)
    while todo:
        for n in links[todo.pop()] - bad:
            bad.add(n)
            todo.append(n)
    out = []
    for page, url, _ in rows:
        r = rule(url)
        method = "block" if url and "://" in url and key(url) in bad and links[key(url)] else "allow"
        out.append((page, *place(url), str(r) if r else None, r.verdict if r else method))
    return out


def canonical(url):
    return f'<html><head><link rel="canonical" href="{url}"></head></html>'


def test_aliases(spark):
    chain = [(100 + i, f"https://c{i}.test/x", canonical(f"https://c{i + 1}.test/x")) for i in range(40)]
    star = [(200 + i, f"http://s{i}.test/", f"<meta http-equiv=refresh content='0; url=\"http://hub.example.com/de/a\"'>") for i in range(60)]
    rows = [
        (1, "http://a.test/p", canonical("http://x.NET/q")), (2, "http://x.net/q#top", None), (3, "http://b.test/p?u=1", canonical("HTTP://A.test/p")),
        (4, "http://w.example.net/en/1", canonical("http://a.test/p")), (5, "http://example.net/en", "<p>"), (6, "http://net/", ""), (7, "http://net", canonical("http://lone.test/")),
        (8, "http://lone.test/", None), (9, None, canonical("http://x.net/q")), (10, "no scheme", canonical("http://x.net/q")), (11, "http://notexample.com/de/", ""),
        (12, "http://www.Example.com/de/x?y=://z.net/", ""), (13, "http://d.example.org/fr/z", canonical("http://x.net/q")), (14, "http://rel.test/a/b", "<base href='//x.net/'><link href=q rel='Alternate CANONICAL'>"),
        (15, "http://com.test/", "<!-- " + canonical("http://x.net/q") + "--><script>'" + canonical("http://x.net/q") + "'</script>"), (16, "http://self.test/", canonical("http://self.test/#x")),
        (17, "http://bad.test/", canonical("http://[oops/")), (18, "http://amp.test/?a=1&b=2", canonical("http://x.net/r?a&amp;b")), (1, "http://a.test/p", canonical("http://x.net/q")),
        (19, "http://open.test/" + "y" * 5000, "<script>" + canonical("http://x.net/q") + "<link" * 2000), (20, "", ""), (21, "://", ""), (22, "http://x.net", "<link rel=canonical href=http://u.test/1>"), (23, "http://u.test/1", ""),
        *chain, (140, "https://c40.test/x", canonical("https://www.example.com/de/")), *star]
    pages = spark.createDataFrame([(*r, "n", "a", 1) for r in rows], PAGES).repartition(3)
    got = sorted((tuple(r) for r in aliases.judged(pages).collect()), key=str)
    assert got == sorted(brute_verdicts(rows), key=str)
    verdicts = {g[0]: g[4] for g in got}
    assert all(verdicts[i] == "block" for i in (1, 2, 3, 14, 18, 100, 139, 200, 259)) and all(verdicts[i] == "allow" for i in (4, 7, 8, 13, 15, 17, 19, 23))
    assert aliases.judged(pages.limit(0)).collect() == []


def brute_clusters(rows, k, rounds, dim):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "z", r[1]))[:k]
    centres = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        parts = collections.defaultdict(list)
        for _, v in kept:
            parts[nearest(v)[1]].append(v)
        for n, vs in parts.items():
            centres[n] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
    return sorted(((i, n, d) for i, v in kept for d, n in [nearest(v)]), key=str), centres


@pytest.mark.parametrize(("k", "dim", "spread"), [(8, 5, 0.2), (12, 3, 0.01), (7, 64, 3.0)])
def test_clusters(spark, k, dim, spread):
    rng = np.random.default_rng(k)
    centres = rng.normal(size=(5, dim))
    rows = [(i, [float(x) for x in centres[i % 5] + spread * rng.normal(size=dim)]) for i in range(220)]
    rows += rows[:30] + [(i, rows[7][1]) for i in range(1000, 1040)]  # repeated rows and vectors
    rows += [(500, None), (501, []), (502, [1.0] * (dim + 1)), (503, [None] + [1.0] * (dim - 1)), (504, [float("nan")] * dim), (505, [float("inf")] + [0.0] * (dim - 1)), (None, [0.5] * dim), (506, [0.0] * dim)]
    df = spark.createDataFrame([(*r, "x", -1) for r in rows], "vec_id long, embedding array<double>, x string, cluster int").repartition(3)
    found, middle = centroids.clustered(df, k=k, rounds=6, dim=dim)
    want, centres = brute_clusters(rows, k, 6, dim)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want and middle.tolist() == centres
    assert centroids.clustered(df.limit(0), dim=dim)[0].collect() == []


def test_clusters_fewer_than_k_and_too_large(spark):
    few = spark.createDataFrame([(1, [0.0, 1.0]), (2, [5.0, 1.0])], "vec_id int, embedding array<float>")
    assert sorted(tuple(r) for r in centroids.clustered(few, dim=2)[0].collect()) in ([(1, 0, 0), (2, 1, 0)], [(1, 1, 0), (2, 0, 0)])
    with pytest.raises(Exception, match="no exact distances"):
        centroids.clustered(spark.createDataFrame([(1, [1e30, 1.0])], "vec_id int, embedding array<double>"), dim=2)[0].collect()


def test_bounds_save_scans():
    """Most exact distances are not computed, and clusters are those of scanning all."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 16))
    x = np.floor(1024 * (centres[rng.integers(8, size=4000)] + 0.1 * rng.normal(size=(4000, 16)))).astype(np.int64)
    now, group = np.floor(1024 * centres).astype(np.int64), centroids.grouped(centres, 3)
    cluster, upper, lower, drift, scanned = np.full(4000, -1), np.zeros(4000), np.zeros((4000, int(group.max()) + 1)), np.zeros(8), 0
    for _ in range(6):
        step = centroids.Step(now, drift, group)
        cluster, upper, lower = step.assign(x, cluster, upper, lower)
        scanned += step.scanned
        full = ((x[:, None, :] - now[None]) ** 2).sum(axis=2)
        assert (cluster == full.argmin(axis=1)).all()
        new = np.array([x[cluster == c].sum(axis=0) // max(1, (cluster == c).sum()) for c in range(8)])
        drift, now = np.sqrt(((new - now) ** 2).sum(axis=1)), new
    assert scanned < 0.3 * 6 * 8 * 4000
