"""Runs against trying every period at every place."""

import hashlib
import random
import re
import zlib

import numpy as np

from tailtrim.llm import periods

SMALL = "/root/testdata/sf0.001"


def plain_runs(words):
    found = []
    for period in range(1, len(words) // 4 + 1):
        i = 0
        while i + period < len(words):
            j = i
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            run = words[i : j + period]
            if j > i and len(run) >= max(6, 4 * period):
                if not any(run[d:] == run[:-d] for d in range(1, period)):
                    found.append((i, j + period, period))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(draw):
    words = []
    for _ in range(draw.randint(1, 6)):
        size, letters = draw.choice([1, 2, 3, 4, 7, 11]), draw.choice([1, 2, 3, 50])
        part = [b"%d" % draw.randint(0, letters) for _ in range(size)]
        if draw.random() < 0.3:
            part = part * draw.randint(2, 6) + part[:1]
        words += part * draw.randint(1, 9) + part[: draw.randint(0, size)]
    return words


def test_random_texts():
    draw = random.Random(3)
    for _ in range(300):
        texts = [random_words(draw), [], random_words(draw)]
        expected = [plain_runs(words) for words in texts]
        assert periods.runs_by_text(texts) == expected
        numbers = np.array([int(w) for w in texts[0]])
        assert periods.runs_of(numbers) == expected[0]


def test_grammar_gives_the_text_back():
    draw = random.Random(4)
    ids = [int(w) for w in random_words(draw) * 3]
    grammar = periods.Grammar(ids)

    def derived(symbol):
        if symbol < grammar.words:
            return [symbol]
        left, right = grammar.rules[symbol - grammar.words]
        return derived(left) + derived(right)

    known = list(dict.fromkeys(ids))
    assert [known[s] for s in derived(grammar.root)] == ids
    assert len(grammar.rules) < len(ids)


def test_long_and_hard_texts():
    assert periods.runs_of(np.zeros(100_000, np.int64)) == [(0, 100_000, 1)]
    period = np.random.default_rng(1).integers(0, 10**6, 3000)
    assert periods.runs_of(np.tile(period, 5)) == [(0, 15_000, 3000)]
    # Three times is no run, and a Fibonacci word holds no fourth power.
    assert periods.runs_of(np.tile(period, 3)) == []
    a, b = [0], [0, 1]
    while len(b) < 5000:
        a, b = b, b + a
    assert periods.runs_of(np.array(b)) == []


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for a, b, q in runs for i in range(a + q, b)}
    best = min(((a - b, a, q) for a, b, q in runs), default=None)
    shown = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
    lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *shown, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def test_query_against_a_plain_version(spark, tmp_path):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in table if len(r.text or "") < 20_000]
    draw = random.Random(6)
    rows += [(10_000 + i, b" ".join(random_words(draw)).decode()) for i in range(200)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = periods.op13_periods(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == sorted(plain_row(*row) for row in rows)
    assert sum(r.n_runs for r in found) > 100


def test_edge_cases(spark, docs, no_docs):
    found = periods.find_runs(docs).collect()
    assert len(found) == docs.count() and found[0].runs == []
    hot = [r for r in found if r.doc_id == 11]
    assert [(r.n_words, r.runs[0].asDict(), r.collapsed) for r in hot] == [
        (3000, {"start": 0, "length": 3000, "period": 1}, "é😀")
    ] * 2
    assert {r.collapsed for r in found if r.doc_id in (4, 5, 6)} == {""}
    assert periods.find_runs(no_docs).count() == 0
