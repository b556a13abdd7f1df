"""Operators that link rows: SimHash, embeddings, aliases, components."""

from __future__ import annotations

import random

import messy
import numpy as np
import pytest
import xxhash

from signalgrid.llm import components, simhash, urls, vectors


def test_components_equal_brute_force(spark):
    rng = random.Random(1)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100, i) for i in range(101, 160)]
    links += [(i, i + 1) for i in range(200, 240)] + [(7, 7), (None, 3)]
    pairs = {frozenset(link) for link in links if None not in link}
    nodes = {node for link in links if None not in link and link[0] != link[1] for node in link}
    want = messy.groups(nodes, lambda a, b: frozenset((a, b)) in pairs)
    found = components.connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {row.node: row.component for row in found} == want and len(found) == len(want)
    assert components.connected_components(messy.nothing(spark, "a long, b long"), "a", "b").isEmpty()


def _print(text):
    words = [w.encode() for w in messy.words_plain("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force_on_odd_rows(spark):
    docs = messy.documents(spark)
    prints = {row.doc_id: _print(row.text) for row in docs.collect() if row.doc_id is not None}
    want = messy.groups(prints, lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 4)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    for row in found:
        if row.doc_id is not None:
            assert (row.fingerprint, row.component_id) == (f"{prints[row.doc_id]:016x}", want[row.doc_id])
    assert simhash.near_duplicates(messy.nothing(spark)).isEmpty()


def test_documents_without_id_link_their_neighbours(spark):
    # One bit more each: only the print without an id joins both ends.
    rows = [(5, 0b1), (None, 0b11111), (9, 0b111111111), (None, -1)]
    classes = components.numbered(spark.createDataFrame(rows, "id long, print long"))
    found = components.with_least_id(classes, simhash.near_links(classes.drop("id")), "u", "v").collect()
    assert {(row.id, row.print): row.component for row in found} == {
        (5, 0b1): 5, (None, 0b11111): 5, (9, 0b111111111): 5, (None, -1): None
    }


def test_vectors_of_null_and_repeated_ids_link(spark):
    def at(degrees):
        return [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))]

    rows = [(1, at(0), 0), (None, at(10), 0), (2, at(20), 0)]
    rows += [(4, at(90), 0), (4, at(95), 0), (None, at(180), 0), (None, at(185), 0), (7, at(90), 1), (7, at(90), 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = [(row.vec_id, row.n_links, row.component_id, row.kept) for row in vectors.near_duplicates(frame).collect()]
    assert sorted(found, key=repr) == sorted(
        [(1, 1, 1, True), (None, 2, 1, False), (2, 1, 1, False), (4, 1, 4, True), (4, 1, 4, True)]
        + [(None, 1, None, False)] * 2
        + [(7, 1, 7, True)] * 2,
        key=repr,
    )


@pytest.mark.parametrize("block", [7, 2048])
def test_links_of_fingerprints_lose_none(spark, block):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(40)] + [0]
    prints = {}
    for node in range(600):
        value = rng.choice(seeds[:6] if node % 2 else seeds)
        for bit in rng.sample(range(64), rng.randrange(6)):
            value ^= 1 << bit
        prints.setdefault(value, node)
    rows = [(value - (1 << 64) if value >> 63 else value, node) for value, node in prints.items()]
    by_node = {node: value for value, node in prints.items()}
    want = messy.groups(by_node, lambda a, b: bin(by_node[a] ^ by_node[b]).count("1") <= 4)
    links = simhash.near_links(spark.createDataFrame(rows, "print long, node long"), block)
    found = {row.node: row.component for row in components.connected_components(links, "u", "v").collect()}
    assert {node: found.get(node, node) for node in want} == want


def test_every_four_positions_hold_a_posting_list():
    from itertools import combinations

    assert all(any(set(t) <= set(four) for t in simhash.COVER) for four in combinations(range(8), 4))


def _vector_rows():
    rng = np.random.default_rng(0)
    base = rng.normal(size=(25, 16))
    rows = []
    for i in range(500):
        vector = base[0 if i % 3 == 0 else i % 25] * rng.uniform(0.1, 9) + rng.normal(size=16) * rng.choice([0, 0.05, 0.2])
        rows.append((i, [float(np.float32(x)) for x in vector], int(i % 2), "x"))
    rows += [(500, rows[0][1], 0, "x"), (501, rows[0][1], 0, "x"), (502, rows[0][1], None, "x"), (503, None, 0, "x")]
    rows += [(504, [0.0] * 16, 0, "x"), (505, [float("nan")] + [1.0] * 15, 0, "x"), (506, [1.0, None] + [0.0] * 14, 0, "x")]
    return rows + [(507, rows[0][1][:8], 0, "x"), (508, [float("inf")] * 16, 0, "x"), (509, [], 0, "x")]


@pytest.mark.parametrize("block", [50, 2048])
def test_embeddings_against_brute_force(spark, block):
    rows = _vector_rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node string")

    def usable(row):
        v = row[1]
        return row[2] is not None and v and None not in v and np.isfinite(v).all() and any(v)

    unit = {row[0]: np.array(row[1]) / np.linalg.norm(row[1]) for row in rows if usable(row)}
    label = {row[0]: (row[2], len(row[1] or [])) for row in rows}

    def linked(a, b):
        return a in unit and b in unit and label[a] == label[b] and unit[a] @ unit[b] >= 0.98

    found = {row.vec_id: row for row in vectors.near_duplicates(frame, block=block).collect()}
    assert len(found) == len(rows)
    links = {a: sum(linked(a, b) for b in label if b != a) for a in label}
    assert all(found[a].n_links <= links[a] for a in links)
    assert sum(row.n_links for row in found.values()) >= 0.98 * sum(links.values())
    want = messy.groups(list(label), linked)
    assert {a: row.component_id for a, row in found.items()} == want
    assert all(row.kept == (row.vec_id == row.component_id) for row in found.values())
    assert vectors.near_duplicates(frame.limit(0)).isEmpty()


def test_urls_follow_aliases_and_prefer_an_allow(spark):
    pages = [
        (1, "http://a.net/1", '<link rel="canonical" href="http://B.example.org/es/x#t">'),
        (2, "http://c.net/", "<META http-equiv=refresh content=\"0; url=/z\">"),
        (3, "http://c.net/z", "<link href='//a.net/1' rel=canonical>"),
        (4, "http://d.net", "<link rel=canonical href='http://e.com/fr/1'>"),
        (5, "http://d.net#x", "<meta http-equiv=refresh content='1;URL=http://x.com/de/q?a=1&amp;b=2'>"),
        (6, None, None),
        (7, "nothing", ""),
        (8, "HTTP://X.COM/de/?a=1#f", ""),
        (9, "http://q.example.org/en/12", ""),
        (9, "http://q.example.org/en/12", ""),
        (10, "http://example.organic/", "<link rel=canonical href='#top'>"),
        (11, "http://r.net/a/b", "<link rel=canonical href='c'>"),
        (None, "http://r.net/a/c", ""),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    redirects = spark.createDataFrame([("http://r.net/a/c", "http://s.com/de/"), (None, "x")], "source string, target string")
    found = urls.judge(frame, redirects=redirects).collect()
    assert len(found) == len(pages)
    verdicts = {(row.page_id, row.rule): row.verdict for row in found}
    assert verdicts == {
        (1, None): "block", (2, None): "block", (3, None): "block", (4, None): "allow", (5, None): "allow",
        (6, None): "allow", (7, None): "allow", (8, "com/de/"): "block", (9, "example.org/en/1"): "block",
        (10, None): "allow", (11, None): "block", (None, None): "block",
    }
    own = {row.page_id: (row.host, row.path) for row in found}
    assert own[6] == own[7] == ("", "") and own[8] == ("x.com", "/de/") and own[4] == ("d.net", "")
    assert urls.judge(frame.limit(0)).isEmpty()
