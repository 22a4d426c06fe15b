"""Patterns against plain expressions, and the models on strings they have not seen."""

import hashlib
import random
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tailtrim.llm import secrets
from tailtrim.llm.common import drawn_texts, text_buffer

SMALL = "/root/testdata/sf0.001"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_spans(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found)]


def test_query_against_plain_patterns(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = secrets.op12_secrets(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        spans = [s for s in row.spans.split(",") if s]
        base = [s for s in spans if not s.startswith("markov")]
        assert base == plain_spans(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [
            sum(s.startswith(kind) for s in base) for kind in ("assign", "access", "hex")
        ]


def test_patterns_on_awkward_texts():
    draw = random.Random(5)
    pieces = [
        "token", "PassWord", "api_key", "APIKEY", "secret", ":", "=", " ", "  ", '"', "'", "\n", "é😀", "x" * 12, "k-._=/+",
        "AKIA", "AKIA" + "Z9" * 7, "0a" * 8, "0A" * 8, "deadbeef", "ſecret", "toKen", ".", "token=password=abcdefghijkl",
    ]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 25))) for _ in range(800)] + [None, ""]
    data, offsets = text_buffer(pa.array(texts, pa.string()))
    found = [[] for _ in texts]
    whole = data.tobytes()
    for row, start, kind, end, _ in secrets.pattern_spans(data, offsets):
        base = int(offsets[row])
        a, b = (len(whole[base:x].decode()) for x in (start, end))
        found[row].append(f"{secrets.KINDS[kind]}:{a}:{b}")
    assert found == [plain_spans(t or "") for t in texts]


def test_models_on_strings_not_seen(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    models = secrets.train(secrets.labelled_samples(docs))
    draw = random.Random(1)
    for alphabet in (string.ascii_letters + string.digits, string.ascii_lowercase + string.digits):
        values = ["".join(draw.choice(alphabet) for _ in range(20)) for _ in range(200)]
        assert np.mean([models.ratio(v.encode()) >= secrets.LEAST_RATIO for v in values]) > 0.95
    words = [w for r in docs.collect() for w in re.findall("[A-Za-z]{16,}", r.text or "")]
    assert np.mean([models.ratio(w.encode()) >= secrets.LEAST_RATIO for w in words]) < 0.01
    assert models.ratio(b"1234567890123456") < secrets.LEAST_RATIO


def test_spans_of_the_models(spark, docs, no_docs):
    models = secrets.train(secrets.labelled_samples(spark.read.parquet(f"{SMALL}/documents.parquet")))
    key, known = "q7Xv0ZkP2mWd9TbR4uYs", "token=q7Xv0ZkP2mWd9TbR4uYs"
    rows = [(1, f"é😀 {key} end"), (2, known), (3, ""), (4, None), (None, key), (5, key + " " + known)]
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string"), models).collect()
    spans = [(r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in found]
    assert spans == [
        (1, [("markov", 3, 23)]), (2, [("assign", 0, 26)]), (3, []), (4, []), (None, [("markov", 0, 20)]),
        (5, [("markov", 0, 20), ("assign", 21, 47)]),
    ]
    assert secrets.find_secrets(docs, models).count() == docs.count()
    assert secrets.find_secrets(no_docs, models).count() == 0
    nothing = secrets.train(secrets.labelled_samples(no_docs))
    assert [len(r.spans) for r in secrets.find_secrets(spark.createDataFrame(rows[:2], "doc_id bigint, text string"), nothing).collect()] == [0, 1]


def test_samples_of_labels_given_by_hand(spark):
    rows = [("abcabcabcabc", "ordinary"), ("zzzzzzzzzzzz", "zeta"), (None, "zeta"), ("x", None)]
    models = secrets.train(spark.createDataFrame(rows, "value string, label string"), generated=0)
    assert models.kinds == ["zeta"]
    assert models.ratio(b"zzzzzzzz") > 0 > models.ratio(b"abcabcabc")


def test_a_repeated_text_is_drawn_once(spark):
    rows = [("hot",)] * 500 + [(f"t{i}",) for i in range(100)] + [(None,)]
    docs = spark.createDataFrame(rows, "text string")
    drawn = [r.text for r in drawn_texts(docs, 40, "seed").collect()]
    assert len(drawn) == len(set(drawn)) == 40
    assert drawn_texts(docs, 1000, "seed").count() == 101
    assert drawn_texts(docs.filter(F.lit(False)), 10, "seed").count() == 0
