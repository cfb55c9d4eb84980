import random

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from costseries.llm import graph, simhash


def slow_print(text):
    found = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    if not found:
        return 0
    grams = [" ".join(found[k : k + 4]) for k in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, distance=4):
    """Smallest id per document by a search over all pairs."""
    out = {}
    for start in range(len(prints)):
        seen, todo = {start}, [start]
        while todo:
            a = todo.pop()
            for b in range(len(prints)):
                if b not in seen and (prints[a][1] ^ prints[b][1]).bit_count() <= distance:
                    seen.add(b)
                    todo.append(b)
        out[prints[start][0]] = min(prints[b][0] for b in seen)
    return out


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abAB éß\t\n\x0b\x1f ", max_size=60))
def test_fingerprint_equals_definition(text):
    assert simhash.fingerprint(text) == slow_print(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_are_all_pairs_within_distance(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for b in base:
        for _ in range(20):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 7)):
                x ^= 1 << bit
            prints.add(x)
    prints = sorted(prints)
    expected = {
        (min(signed(a), signed(b)), max(signed(a), signed(b)))
        for k, a in enumerate(prints) for b in prints[k + 1 :] if (a ^ b).bit_count() <= 4
    }
    frame = spark.createDataFrame([(signed(p),) for p in prints], "f long")
    for parts in (None, 2, 3, 4, 5):
        assert {tuple(r) for r in simhash.links(frame, 4, parts).collect()} == expected


def test_segments_keep_chance_matches_in_proportion():
    assert [simhash.segments(n) for n in (0, 10**3, 5 * 10**4, 10**6, 10**8, 10**9)] == [5, 5, 4, 3, 2, 2]
    assert [simhash.segments(10**6, d) for d in (0, 1)] == [1, 2]
    for n in (10**4, 10**6, 10**8, 10**9):
        met = sum(
            len(simhash._ball(width, radius)) * n / 2**width for width, radius in simhash._radii(4, simhash.segments(n)) if radius >= 0
        )
        assert met < 600


def test_components_of_chains_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {k: 200 for k in (200, 201, 202)}


def test_query_equals_brute_force(spark, table):
    sample = table("documents")
    prints = [(r.doc_id, slow_print(r.text)) for r in sample.collect()]
    expected = slow_groups(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(sample).collect()}
    assert got == {d: (f"{p:016x}", expected[d]) for d, p in prints}


def test_odd_rows(odd, no_docs):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert {r.component_id for r in zero} == {1} and len(zero) == 4
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 4, 4, 5, 8, 9] or sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 4, 5, 8, 9]
    assert sum(r.doc_id is None for r in rows) == 1
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0
