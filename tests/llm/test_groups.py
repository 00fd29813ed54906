"""Whole results of the n-gram join, of the row that stays of each group, and of mixing by many sources, against plain versions."""

import re
from collections import Counter

import pytest

from millrace.llm import mixing, ngram_join
from millrace.llm.common import documents
from millrace.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def plainly_grouped(rows, words, percent):
    """The smallest id reachable by links, by comparing whatever shares a shingle."""
    sets = [shingles(text, words) for _, text in rows]
    holders = {}
    for i, own in enumerate(sets):
        for s in own:
            holders.setdefault(s, []).append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in enumerate(sets):
        for j, both in Counter(j for s in own for j in holders[s] if j < i).items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(doc_id, len(own), least[find(i)]) for i, ((doc_id, _), own) in enumerate(zip(rows, sets, strict=True))]


@pytest.fixture(scope="module")
def rows(spark):
    return [(r.doc_id, r.text) for r in documents(spark, SMALL).select("doc_id", "text").collect()]


def test_ngram_query_equals_a_plain_version(spark, rows):
    got = QUERIES["op6_ngram_join"](spark, SMALL).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(plainly_grouped(rows, 3, 90))


def test_the_stage_keeps_the_first_of_each_group(spark, rows):
    docs = documents(spark, SMALL)
    kept = ngram_join.one_of_each(docs, 5, 80)
    want = sorted(doc_id for doc_id, _, least in plainly_grouped(rows, 5, 80) if doc_id == least)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == want
    assert kept.exceptAll(docs).isEmpty()


def test_rows_stay_whole_beside_clashing_names(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long, 10, 1), (2, long, 20, 2), (3, "alone here", 30, 3), (None, long, 40, 4), (4, None, 50, 5), (5, "", 60, 6)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, __doc int, again int")
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter(r for r in rows if r[0] != 2)
    assert ngram_join.one_of_each(docs.limit(0)).count() == 0


@pytest.mark.parametrize("few", [0, mixing.FEW])
def test_many_sources_take_the_same_by_both_joins(spark, monkeypatch, few):
    rows = [(i, "w " * (i % 7), None if i % 3 == 0 else f"s{i % 50}") for i in range(600)] * 2
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    want = Counter(map(tuple, mixing.mix(docs).collect()))
    texts = Counter(map(tuple, mixing.repeated(docs).collect()))
    monkeypatch.setattr(mixing, "FEW", few)
    got = mixing.mix(docs)
    assert Counter(map(tuple, got.collect())) == want and sum(want.values()) == 1200
    assert Counter(map(tuple, mixing.repeated(docs).collect())) == texts
    taken, targets = Counter(), {}
    for (_, source, _, _, target, words), times in want.items():
        taken[source] += words * times
        targets[source] = target
    assert all(abs(taken[s] - target) <= 2 for s, target in targets.items())
