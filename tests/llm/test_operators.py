"""Each operator on edge cases, on an empty table, and against a plain version of itself."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import product

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from edge_cases import BASE, ROWS

from tailtrim.llm import (
    chat,
    decontamination,
    fingerprints,
    language,
    linededup,
    mixing,
    neardup,
    queries,
    sharding,
    tokens,
    toxicity,
)
from tailtrim.llm.components import components
from tailtrim.llm.shingles import shingle_sets, word_hashes

SMALL = "/root/testdata/sf0.001"


def by_id(df):
    return {row.doc_id: row for row in df.collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    expected = db.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in expected.description]
    found = queries.QUERIES[name](spark, SMALL)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(tuple(r) for r in found.select(columns).collect()) == Counter(expected.fetchall())


def test_language(spark, docs, no_docs):
    model = language.train(docs)
    found = language.identify(docs, model).collect()
    assert len(found) == len(ROWS)
    for row in found:
        if row.doc_id in (4, 5, 6):
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
        else:
            assert row.lang_pred in ("en", "de", "fr") and 0 <= row.score <= 1
    assert language.train(no_docs) is None
    assert language.identify(no_docs, None).count() == 0
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    found = {r.doc_id: r for r in language.op1_language(spark, SMALL).collect()}
    truth = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").collect()
    held = [found[r.doc_id].lang_pred == r.lang for r in truth if found[r.doc_id].held_out and r.lang]
    assert np.mean(held) > 0.95


def test_line_templates(spark, docs, no_docs):
    found = by_id(linededup.drop_recurring_lines(docs))
    assert (found[9].n_lines, found[9].n_dropped, found[9].text) == (3, 2, "own line here")
    assert found[10].text == "last 12 of it"
    assert found[4].text == "" and found[5].text == "" and found[6].n_lines == 0
    # The two equal rows are one document, so nothing of them recurs.
    assert found[11].n_dropped == 0
    rows = [(1, "user 17 logged in\nfree"), (2, "user 9 logged in\nother words"), (3, "user logged in")]
    masked = by_id(linededup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert [masked[i].text for i in (1, 2, 3)] == ["free", "other words", "user logged in"]
    assert linededup.drop_recurring_lines(no_docs).count() == 0


def test_line_templates_beside_the_most_widespread(spark):
    """Lines of one leaf that are alike to each other but not to its most widespread line."""
    hub, other, third, alone = (" ".join(["a b c", *(f"{x}{i}" for i in "klmnopq")]) for x in "xyzw")
    rows = [(i, f"{hub} same") for i in range(3)] + [(16, "")]
    rows += [(10, f"{other} one\nown"), (11, f"{other} two"), (12, f"{third} one"), (13, f"{third} two"), (14, f"{alone} one")]
    found = by_id(linededup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert {i: r.n_dropped for i, r in found.items()} == {0: 1, 1: 1, 2: 1, 10: 1, 11: 1, 12: 1, 13: 1, 14: 0, 16: 0}
    assert found[10].text == "own"


def test_line_templates_against_a_plain_version(spark):
    draw = random.Random(8)
    rows = [(i, " ".join(["a b c", *(draw.choice("xy") for _ in range(9))])) for i in range(60)]
    rows += [(100 + i, " ".join(["d e f", *(draw.choice("xyz") for _ in range(2))])) for i in range(12)]
    docs, leaves, template, spread = defaultdict(set), defaultdict(list), {}, defaultdict(set)
    for doc_id, text in rows:
        docs[tuple(text.split())].add(doc_id)
    for words in sorted(docs, key=lambda w: (-len(docs[w]), w)):
        hubs = leaves[len(words), words[:3]]
        near = (h for h in hubs if sum(map(str.__eq__, h, words)) >= 0.8 * len(words))
        template[words] = next(near, words)
        if template[words] is words:
            hubs.append(words)
        spread[template[words]] |= docs[words]
    assert max(map(len, leaves.values())) > 3
    found = by_id(linededup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id bigint, text string")))
    expected = {i: int(len(spread[template[tuple(text.split())]]) > 1) for i, text in rows}
    assert {i: r.n_dropped for i, r in found.items()} == expected


@pytest.mark.parametrize("pairs", [1, 15])
def test_rounds_do_not_grow_with_the_templates_of_a_leaf(spark, monkeypatch, pairs):
    """Pairs of alike lines, all in one leaf, none alike to a line of another pair."""
    saves = []
    monkeypatch.setattr(linededup, "saved", lambda df, name, save=linededup.saved: saves.append(name) or save(df, name))
    rows = []
    for i in range(pairs):
        words = [f"{chr(97 + i)}{c}" for c in "klmnopqrs"]
        rows += [(2 * i, " ".join(["a b c", *words, "one"])), (2 * i + 1, " ".join(["a b c", *words, "two"]))]
    found = linededup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.n_dropped for r in found} == {1} and len(found) == 2 * pairs
    assert saves.count("hubs") == 1


def test_words_and_shingles():
    text = "A b\tC\x0bd\n e　f " * 3
    data, offsets = np.frombuffer((text + "a b").encode(), np.uint8), np.array([0, len(text.encode()), len(text.encode()) + 3])
    hashes, rows = word_hashes(data, offsets)
    words = re.findall(r"[^\x20\x09-\x0d]+", text.lower()) + ["a", "b"]
    assert len(hashes) == len(words) and len(set(hashes.tolist())) == len(set(words))
    assert shingle_sets(data, offsets, 3)[1].shape == (1,)


def plain_components(rows, words, above, of):
    sets = {}
    for doc_id, text in rows:
        found = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in product(sets, sets):
        if a < b and sets[a] and sets[b] and of * len(sets[a] & sets[b]) >= above * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates(spark, docs, no_docs):
    found = by_id(neardup.near_duplicates(docs, neardup.OP3_SETTINGS))
    assert found[1].component_id == found[2].component_id == found[3].component_id == 1
    assert [found[i].kept for i in (1, 2, 4, 5, 6)] == [True, False, True, True, True]
    assert found[None].kept and found[None].component_id is None and found[7].n_shingles == 1
    assert neardup.near_duplicates(no_docs).count() == 0


def test_near_duplicates_of_a_mutated_group(spark):
    """A group of copies with from none to many changes, whose links are not all to one of them."""
    draw = random.Random(5)
    words = [f"v{draw.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(250):
        own = [w if draw.random() > (i % 12) / 300 else f"n{draw.randrange(10**6)}" for w in words]
        rows.append((i, " ".join(own)))
    found = by_id(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), neardup.OP3_SETTINGS))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == plain_components(rows, 3, 85, 100)


def test_sketches_estimate_similarity():
    draw = np.random.default_rng(3)
    common, rest = draw.integers(0, 2**63, (2, 400)).astype(np.uint64)
    a, b = np.r_[common, rest[:50]], np.r_[common, rest[50:100]]
    regs = neardup.sketch(np.r_[a, b], np.repeat([0, 1], [450, 450]), 2, 512)
    union = neardup.sketch(np.r_[common, rest[:100]], np.zeros(500, int), 1, 512)
    assert (np.maximum(regs[0], regs[1]) == union[0]).all()
    found = neardup.likely_similarity(regs[:1], regs[1:], np.array([450]), np.array([450]))
    assert abs(found[0] - 0.8) < 0.08


def test_components(spark):
    edges = [(2, 1), (3, 2), (4, 3), (9, 8), (8, 7), (5, 5), (20, 10), (20, 11)]
    found = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7, 10: 10, 11: 10, 20: 10}


def test_tokens(spark, docs, no_docs, tmp_path):
    from tokenizers import Tokenizer

    path = tokens.public_tokenizer()
    tokens.write_tokens(docs, str(tmp_path / "t"), path)
    found = sorted(tokens.read_tokens(spark, str(tmp_path / "t")).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(path)
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for row, (doc_id, text, *_) in zip(found, order, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert (row.doc_id, row.start, row.n_tokens, row.ids) == (doc_id, start, len(ids), ids)
        start += len(ids)
    digest = {r.start: r.ids_crc32 for r in tokens.token_digests(spark, str(tmp_path / "t")).collect()}
    assert digest == {r.start: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in found}
    segment = spark.read.parquet(str(tmp_path / "t/segments")).first()
    dictionary = bytes(spark.read.parquet(str(tmp_path / "t/dictionary")).first().dictionary)
    (one,) = tokens.documents_of(bytes(segment.payload), segment.offsets, dictionary, which=[0])
    assert len(one) == segment.n_tokens[0]
    tokens.write_tokens(no_docs, str(tmp_path / "none"), path)
    assert tokens.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_pieces_give_the_ids_of_whole_texts():
    draw = random.Random(2)
    texts = ["".join(draw.choice(" \n\ta1é!'s.,　中😀\x1c|") for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    encoder = tokens.Encoder(tokens.public_tokenizer())
    whole = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    found = tokens._of_texts(*encoder(pa.array(texts)))
    for ids, expected in zip(found, whole, strict=True):
        assert ids.tolist() == [*expected.ids, 0]


def test_ids_of_a_whole_table_against_plain_encoding(spark, tmp_path):
    """The registered query, and ids that fill whole ranges, one of them null."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows += [(None, f"no id {i}") for i in range(150)] + [(7, f"hot {i}") for i in range(150)] + [(9, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(tokens.op4_tokens(spark, str(tmp_path)).collect(), key=lambda r: r.start)
    encoder = tokens.Encoder(tokens.public_tokenizer())
    plain = defaultdict(Counter)
    for (doc_id, _), whole in zip(rows, encoder.tokenizer.encode_batch([text or "" for _, text in rows], add_special_tokens=False)):
        ids = [*whole.ids, 0]
        plain[doc_id][len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert [r.doc_id for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    at = 0
    for row in found:
        assert row.start == at
        plain[row.doc_id][row.n_tokens, row.ids_crc32] -= 1
        at += row.n_tokens
    assert not any(n for own in plain.values() for n in own.values())


def test_mixing(docs, no_docs):
    found = mixing.mix(docs).collect()
    assert len(found) == len(ROWS)
    for row in found:
        assert row.taken <= 3 * row.size and (row.size == 0 or row.taken % row.size == 0)
    targets = {row.source: row.target for row in found}
    assert abs(sum(targets.values()) - sum(row.size for row in found)) < 1e-6
    assert all(row.target <= 3 * row.source_size for row in found)
    assert Counter(map(tuple, found)) == Counter(map(tuple, mixing.mix(docs).collect()))
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_sharding(docs, no_docs):
    found = sharding.shard(docs, shards=4, nodes=8, keep=docs.columns).collect()
    slots = defaultdict(list)
    for row in found:
        slots[row["shard"]].append(row.slot)
    assert sorted(map(len, slots.values())) == [3, 3, 3, 4]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = {r[0]: r[1] or "" for r in ROWS}
    assert all(r["size"] == 16 + len(text[r.doc_id].encode()) for r in found)
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in found)
    assert sharding.shard(no_docs).count() == 0


def test_chat(spark):
    draw = random.Random(1)
    for _ in range(3000):
        turns = [
            (draw.choice(["user", "assistant", "a\n\\n|>", "<|x"]), "".join(draw.choice("<|>\\\nend") for _ in range(draw.randint(0, 12))))
            for _ in range(draw.randint(0, 4))
        ]
        formatted, mask = chat.format_turns(turns)
        assert chat.read_turns(formatted) == turns
        assert [chat.unescape(formatted[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]
    records = [
        (1, '{"messages": [{"role": "user", "content": "q"}, {"role": "gpt", "content": null}], "extra": 1}'),
        (2, '{"instruction": "do", "input": "this", "output": "done"}'),
        (3, '{"conversations": [{"from": "human", "value": "v"}]}'),
        (4, "not json"),
        (5, None),
        (None, '{"data": {"prompt": "p", "response": "r"}}'),
    ]
    found = {r.id: r for r in chat.format_records(spark.createDataFrame(records, "id bigint, record string")).collect()}
    assert [found[i].layout for i in (1, 2, 3, 4, 5, None)] == [
        "messages", "instruction_input", "conversations", None, None, "nested_data",
    ]
    assert chat.read_turns(found[2].formatted) == [("user", "do\n\nthis"), ("assistant", "done")]
    assert [found[i].n_turns for i in (1, 4, 5)] == [2, 0, 0]


def test_rows_of_several_layouts(spark):
    """The mapping of each row follows from the paths of its fields, nested ones too."""
    schema = (
        "conv_id bigint, turn bigint, role string, text string, content string, `from` string, value string, "
        "prompt string, response string, data struct<prompt:string,response:string>, "
        "message struct<role:string,content:string>, system string, layout string, place int"
    )

    def row(conv_id, turn=None, layout="x", place=5, **fields):
        names = ["role", "text", "content", "from", "value", "prompt", "response", "data", "message", "system"]
        return (conv_id, turn, *[fields.get(name) for name in names], layout, place)

    rows = [
        row(1, 1, role="user", text="a"), row(1, 2, role="assistant", content="b"),
        row(1, 3, **{"from": "human"}, value="c"), row(1, 4, prompt="d", response="e"),
        row(1, 5, data=("f", "g")), row(1, 6, message=("gpt", "h")), row(1, 7, system="i", prompt="j", response="k"),
        row(2, 1, role="assistant"), row(2, 2, text="only"), row(2), row(2, 3, data=(None, None)),
        row(3, 1, text="two", content="texts"), row(4, 1, prompt="p", response="q"), row(4, 1, prompt="o", response="r"),
    ]
    table = spark.createDataFrame(rows, schema)
    pieces = sorted(chat.format_rows(table).collect(), key=lambda r: (r.id, r.piece))
    turns = defaultdict(list)
    for piece in pieces:
        turns[piece.id] += chat.read_turns(piece.formatted)
    assert turns[1] == [
        ("user", "a"), ("assistant", "b"), ("user", "c"), ("user", "d"), ("assistant", "e"), ("user", "f"),
        ("assistant", "g"), ("assistant", "h"), ("system", "i"), ("user", "j"), ("assistant", "k"),
    ]
    assert turns[2] == [("user", ""), ("assistant", ""), ("user", "only"), ("user", "")]
    assert turns[3] == [] and [(r.layout, r.n_turns) for r in pieces if r.id == 3] == [(None, 0)]
    assert turns[4] == [("user", "o"), ("assistant", "r"), ("user", "p"), ("assistant", "q")]
    assert [r.layout for r in pieces if r.id == 1] == [
        "rows", "rows_content", "rows_value", "prompt_response", "nested_data", "rows_message", "system_prompt_response",
    ]
    assert pieces[0].fingerprint == chat.fingerprint({"turn", "role", "text"}, chat._KNOWN_IN_ROWS)
    assert len({r.fingerprint for r in pieces if r.id == 1}) == 7
    digest = {r.conv_id: r for r in chat.digests(chat.format_rows(table)).collect()}
    assert {i: digest[i].n_turns for i in (1, 2, 3, 4)} == {1: 11, 2: 4, 3: 0, 4: 4}


def test_chat_query(spark):
    found = {r.conv_id: r for r in chat.op7_chat(spark, SMALL).collect()}
    rows = defaultdict(list)
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        rows[r.conv_id].append((r.turn, r.role, r.text or ""))
    text = "\\### Assistant: </turn> ok"
    rows[-7] = [(0, "user", text), (1, "assistant", text)]
    assert set(found) == set(rows)
    for conv_id, turns in rows.items():
        turns.sort()
        whole = "".join(f"{role}\n{body}\n" for _, role, body in turns)
        learned = "".join(body for _, role, body in turns if role == "assistant")
        row = found[conv_id]
        assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_a_long_conversation_comes_in_pieces(spark):
    draw = random.Random(9)
    rows = [(None if i % 3 else i % 2, i // 2, draw.choice(["user", "gpt", None]), draw.choice(["", None, "a<|b\\é😀" * 9])) for i in range(5000)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    pieces = chat.format_rows(table, piece_chars=1000)
    assert "collect_list" not in pieces._jdf.queryExecution().toString()
    by_conv = defaultdict(list)
    for r in sorted(pieces.collect(), key=lambda r: r.piece):
        assert len(r.formatted) < 1000 + 300 and r.layout == "rows"
        by_conv[r.id].append(r)
    digest = {r.conv_id: r for r in chat.digests(pieces).collect()}
    assert set(by_conv) == set(digest) == {None, 0, 1} and len(by_conv[None]) > 50
    for conv_id, found in by_conv.items():
        own = sorted((t, role or "", text or "") for c, t, role, text in rows if c == conv_id)
        turns = [({"": "user", "gpt": "assistant"}.get(role, role), text) for _, role, text in own]
        formatted, spans = chat.format_turns(turns)
        assert "".join(r.formatted for r in found) == formatted
        assert [(s.start, s.end) for r in found for s in r.mask] == spans
        assert [r.piece for r in found] == list(range(len(found)))
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        assert digest[conv_id].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (digest[conv_id].n_turns, digest[conv_id].formatted_chars) == (len(turns), len(formatted))
        learned = "".join(text for role, text in turns if role == "assistant")
        assert digest[conv_id].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def semi_global(item, text):
    previous = list(range(len(item) + 1))
    best = previous[-1]
    for letter in text:
        current = [0]
        for i, own in enumerate(item, 1):
            current.append(min(previous[i] + 1, current[-1] + 1, previous[i - 1] + (own != letter)))
        previous, best = current, min(best, current[-1])
    return best


def test_edit_matching():
    draw = random.Random(3)
    for _ in range(150):
        item = decontamination.normal("".join(draw.choice("abcd ") for _ in range(draw.randint(5, 70)))) or "x"
        copy = list(item)
        for _ in range(draw.randint(0, 6)):
            place = draw.randrange(len(copy) + 1)
            copy[place : place + draw.randint(0, 1)] = draw.choice(["", "a", "b"])
        noise = ["".join(draw.choice("abcd ") for _ in range(60)) for _ in range(2)]
        text = decontamination.normal(noise[0] + "".join(copy) + noise[1])
        found = decontamination.Matcher([(1, item)], 0.1)(text)
        distance = semi_global(item, text)
        assert (1 in found) == (distance <= len(item) // 10)
        assert 1 not in found or found[1][0] == distance


def test_decontamination(spark, docs, no_docs):
    items = [(1, BASE[100:300]), (2, BASE[100:300].upper()), (3, None), (4, ""), (None, "one two"), (5, "Own  Line")]
    items = spark.createDataFrame(items, "item_id bigint, text string")
    for block_bytes in (10**6, 100):
        lines = decontamination.find_items(docs, items, block_bytes=block_bytes).collect()
        found = {r.row.doc_id: [f.item_id for f in r.found] for r in lines}
        assert len(lines) == len(ROWS) and found[1] == found[3] == [1] and found[9] == [5]
        assert not any(found[i] for i in (4, 5, 6, 7, 8, 10, 11, None))
    clean = decontamination.without_items(docs, items)
    assert clean.columns == docs.columns and clean.count() == len(ROWS) - 4
    assert decontamination.find_items(no_docs, items).count() == 0
    assert decontamination.without_items(docs, items.filter("false")).count() == len(ROWS)


def test_chain_against_enumeration():
    draw = np.random.default_rng(1)
    transitions, sizes = draw.normal(size=(2, 2)), np.array([3, 0, 1, 9, 200])
    scores = draw.normal(size=sizes.sum()) * 2
    found, first = toxicity.marginals(scores, sizes, transitions), 0
    for size in sizes[:4].tolist():
        total, sums = 0.0, np.zeros(size)
        for states in product((0, 1), repeat=size):
            weight = np.exp(scores[first : first + size] @ np.array(states) + sum(transitions[a, b] for a, b in zip(states, states[1:])))
            total, sums = total + weight, sums + weight * np.array(states)
        assert np.allclose(found[first : first + size] * total, sums)
        first += size
    whole, _ = toxicity._padded_marginals(scores[None, first:], transitions, np.ones((1, 200), bool))
    assert np.allclose(whole[0], found[first:])


def test_the_driver_holds_the_words_of_one_document_of_the_sample():
    sample = [(" ".join(["vile"] * (i % 2) + [f"word{i}x{j}" for j in range(300)]), i % 2) for i in range(200)]
    tracemalloc.start()
    try:
        odds, telling = toxicity._evidence(sample)
        _, counting = tracemalloc.get_traced_memory()
        tracemalloc.reset_peak()
        windows, tags = toxicity._windows(sample, {unit: 7 for unit in telling}, telling)
        _, cutting = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert telling == {"vile$"} and odds["vile$"] > toxicity.LEAST_EVIDENCE
    assert windows.shape == (200, 64, 2) and tags.sum() == 100
    # Bytes for each of the 60,000 different words and of the words in stretches.
    assert counting / 60_000 < 120
    assert cutting / tags.size < 160


def test_toxicity(spark, docs, no_docs):
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(300):
        words = ["".join(draw.choice("bcdfgaeiou") for _ in range(draw.randint(2, 5))) for _ in range(60)]
        words[50] += "7"
        # Capitals and marks are common in clean words, too.
        words[20:24] = [w.upper() for w in words[20:24]]
        words[40] += "."
        toxic = i % 4 == 0
        if toxic:
            words[10] = words[30] = draw.choice(["Vile,", "VILE", "awful."])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    labelled = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(table, labelled)
    scored = toxicity.score(table, model).collect()
    assert all((r.score >= 0.5) == (r.row.doc_id % 4 == 0) for r in scored)
    spans = {r.row.text[s.start : s.end] for r in scored for s in r.spans}
    assert spans == {"Vile,", "VILE", "awful."}
    edge = toxicity.score(docs, model).collect()
    assert len(edge) == len(ROWS) and all(0 <= r.score < 0.5 and not r.spans for r in edge)
    assert toxicity.not_toxic(table, labelled).count() == 225
    assert toxicity.score(no_docs, model).count() == 0
    nothing = toxicity.fit(no_docs, labelled.filter("false"))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}


def plain_score(model, text):
    """The document score of a fitted chain, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shapes = [toxicity.features(w, model.evidence) for w in words]
    weights = []
    for i, (a, b) in enumerate(shapes):
        weight = model.own[a] + model.own[b]
        weight += model.before[list(shapes[i - 1])].sum() if i else 0
        weight += model.after[list(shapes[i + 1])].sum() if i + 1 < len(words) else 0
        weights.append(np.array([1.0, np.exp(np.clip(weight, -30, 30))]))
    move = np.exp(model.transitions - model.transitions.max())
    ahead, behind = [], [np.ones(2)]
    for i, local in enumerate(weights):
        state = local if not i else (ahead[-1] @ move) * local
        ahead.append(state / state.sum())
    for local in weights[:0:-1]:
        state = move @ (behind[-1] * local)
        behind.append(state / state.sum())
    joint = [a * b for a, b in zip(ahead, behind[::-1])]
    chances = np.array([j[1] / j.sum() for j in joint])
    expected = chances[chances >= toxicity.FLOOR].sum()
    inputs = np.array([1.0, np.log(expected + 0.01), np.log(expected + 0.01) - np.log(len(words) + 20)])
    found = 1 / (1 + np.exp(-np.clip(inputs @ model.calibration, -40, 40)))
    return found if (chances >= 0.5).any() else min(found, toxicity.UNFLAGGED)


def test_document_scores_against_a_plain_chain(spark):
    draw = random.Random(13)
    rows = []
    for i in range(200):
        words = ["".join(draw.choice("bcdaeiou") for _ in range(4)) for _ in range(draw.randint(20, 200))]
        if i % 4 == 0:
            words[5:7] = draw.choice([["Vile", "vile."], ["awful", "ok"], ["x", "AWFUL"]])
        rows.append((i, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(table, spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id bigint, toxic int"))
    assert not isinstance(model, float)
    scored = toxicity.score(table, model).collect()
    assert {r.score >= 0.5 for r in scored} == {True, False}
    for row in scored:
        assert row.score == pytest.approx(plain_score(model, row.row.text or ""), abs=1e-9)


def test_a_long_clean_text_stays_clean(spark):
    draw = random.Random(12)
    rows = [(i, " ".join("".join(draw.choice("bcdaeiou") for _ in range(4)) for _ in range(60))) for i in range(200)]
    rows = [(i, text.replace(text.split()[9], "vile", 1) if i % 4 == 0 else text) for i, text in rows]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(table, spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id bigint, toxic int"))
    long = [(i, " ".join([text] * 1000)) for i, text in rows[1:4]]
    found = toxicity.score(spark.createDataFrame(long, "doc_id bigint, text string"), model).collect()
    assert all(r.score < 0.5 and not r.spans for r in found)


def test_an_item_that_fills_the_benchmark(spark):
    item = "the quick brown fox jumps over the lazy dog near the old river bank"
    items = [(100 + i, item.upper() if i % 2 else f" {item}\t") for i in range(300)] + [(1, "another item that is quite long indeed"), (2, "")]
    blocks = list(decontamination.item_blocks(spark.createDataFrame(items, "item_id bigint, text string"), block_bytes=40))
    assert len(blocks) > 1
    assert sorted(x for block in blocks for x in block) == [(1, "another item that is quite long indeed"), (100, item)]
    docs = spark.createDataFrame([(1, f"so {item.title()}!"), (2, "clean"), (3, None)], "doc_id bigint, text string")
    found = decontamination.find_items(docs, spark.createDataFrame(items, "item_id bigint, text string"), block_bytes=40)
    assert {r.row.doc_id: [f.item_id for f in r.found] for r in found.collect()} == {1: [100], 2: [], 3: []}


def test_winnowing_against_a_plain_version():
    draw = random.Random(6)
    for size in (0, 1, 31, 32, 33, 140, 900):
        text = "".join(draw.choice("ab é") for _ in range(size)) + "a" * (size // 4)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        chosen = set()
        if len(text):
            gram = min(fingerprints.GRAM, len(text))
            hashes = fingerprints._gram_hashes(points, gram).tolist()
            window = min(fingerprints.WINDOW, len(hashes))
            for i in range(len(hashes) - window + 1):
                low = min(hashes[i : i + window])
                chosen.add(max(p for p in range(i, i + window) if hashes[p] == low))
        assert fingerprints.winnow(text)[1].tolist() == sorted(chosen)


def test_fingerprints(docs, no_docs):
    found = fingerprints.edited_fingerprints(docs).collect()
    assert len(found) == len(ROWS)
    own = {r.doc_id: r for r in found}
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    for (doc_id, text, *_), (_, following, *_) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        if doc_id != 11:
            assert own[doc_id].n_chars == len(text)
            assert own[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert own[4].fingerprint == "" and own[4].near_edited == 1.0
    assert fingerprints.edited_fingerprints(no_docs).count() == 0
    assert fingerprints.fingerprints(docs).count() == len(ROWS)


def test_fingerprints_of_short_texts_see_what_an_edit_leaves(spark):
    draw = random.Random(7)
    sizes = [46, 47, 60, 90, 130, 180, 249] * 6
    rows = [(i, "".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))) for i, n in enumerate(sizes)]
    found = fingerprints.edited_fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(found) == len(rows) and min(r.near_edited for r in found) > 0
    # Texts that share 23 code points anywhere share a hash.
    passage = "the shared twenty-three"
    for _ in range(200):
        a, b = ("".join(draw.choice("abcdefgh ") for _ in range(draw.randint(0, 300))) for _ in range(2))
        cut = draw.randint(0, len(a))
        hashes = [fingerprints.winnow(text)[0] for text in (a[:cut] + passage + a[cut:], b + passage)]
        assert fingerprints.likeness(*hashes) > 0
