"""Fingerprints, quality, language model scores, secrets and chat formatting against plain computations."""

from __future__ import annotations

import math
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.conftest import words
from tablewright.llm import chat, imatch, knn_quality, secrets, suffix_tree
from tablewright.llm.queries import QUERIES, table


def test_edited_texts_and_equal_fingerprints(docs, empty):
    found = imatch.compare_with_next(docs, imatch.lexicon(docs)).collect()
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(found) == len(texts)
    edited = {}
    for (key, own), (_, after) in zip(texts, texts[1:] + texts[:1], strict=True):
        half = len(own) // 2
        edited.setdefault(key, set()).add(sha256((own[: len(own) - half] + after[:half]).encode()).hexdigest())
    assert all(r.edited_sha256 in edited[r.doc_id] for r in found)
    marks = {r.doc_id: r.fingerprint for r in found}
    assert marks[7] == marks[8] and marks[1] == marks[2] and marks[4] == marks[5]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert imatch.compare_with_next(empty, imatch.lexicon(empty)).count() == 0


def test_lexicon_is_the_band(docs):
    texts = [set(words(r.text)) for r in docs.collect()]
    count = Counter(w for t in texts for w in t)
    kept = [w for w, n in count.items() if n >= 2 and math.log(2) <= math.log(len(texts) / n) <= math.log(8)]
    assert len(imatch.lexicon(docs, math.log(2), math.log(8))) == len(kept) > 3


def test_halves_are_more_alike_than_neighbours(spark, sf_dir):
    rows = QUERIES["op5_imatch"](spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "documents").count()
    assert np.mean([r.near_edited for r in rows]) > 5 * np.mean([r.near_next for r in rows])


def test_quality_on_held_out_documents(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    rows = QUERIES["op6_knn_quality"](spark, sf_dir).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    good = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 1]
    bad = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 0]
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.95


def test_quality_with_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (10, 0), (7, None), (None, 1), (99, 1), (1, 1), (2, 5)], "doc_id long, quality int")
    space = knn_quality.fit(docs, labels, "quality")
    scores = {(r.doc_id, r.text): r.score for r in knn_quality.score(docs, space).collect()}
    assert scores[4, ""] == scores[5, None] == space.prior
    assert scores[2, "the quick brown fox jumps over the lazy dog and runs away from the old grey wolf in the WOOD"] > 0.5
    assert knn_quality.score(empty, space).count() == 0
    nothing = knn_quality.fit(docs, labels.limit(0), "quality")
    assert {r.score for r in knn_quality.score(docs, nothing).collect()} == {0.5}
    assert knn_quality.score(docs, knn_quality.fit(empty, labels, "quality")).count() == docs.count()


def brute_scores(train, texts, depth, least_share):
    """The suffix tree on plain dictionaries."""
    grams = [Counter() for _ in range(depth + 1)]
    for t in train:
        tokens = [*words(t), None]
        for n in range(depth + 1):
            grams[n].update(tuple(tokens[i - n : i + 1]) for i in range(n, len(tokens)))
    total, distinct = sum(grams[0].values()), len(grams[0])
    least = max(2.0, least_share * total)
    share = [{g: n / total for g, n in grams[0].items() if n >= least}]
    kept: list[dict] = []
    for n in range(1, depth + 1):
        listed = {g: c for g, c in grams[n].items() if c >= least}
        own = {g: c / grams[n - 1][g[:-1]] for g, c in listed.items()}
        contexts = {}
        for context in {g[:-1] for g in listed}:
            rows = [g for g in listed if g[:-1] == context]
            occurs = grams[n - 1][context]
            before = [share[n - 1][g[1:]] for g in rows]
            left = occurs - sum(listed[g] for g in rows)
            gain = sum(listed[g] * math.log(own[g] / b) for g, b in zip(rows, before, strict=True))
            gain += left * math.log(max(left / occurs, 1e-12) / max(1 - sum(before), 1e-9))
            if gain > 0.5 * len(rows) * math.log(max(total, 2)):
                mass = (left + suffix_tree.DISCOUNT * len(rows)) / occurs
                contexts[context] = (mass, {g[-1]: (listed[g] - suffix_tree.DISCOUNT) / occurs for g in rows})
        kept.append(contexts)
        share.append(own)
    out = []
    for t in texts:
        tokens, base, score = [*words(t), None], 0.0, 0.0
        for i, w in enumerate(tokens):
            p = (grams[0][w,] + 1) / (total + distinct + 1)
            base += math.log10(p)
            for n in range(1, min(depth, i) + 1):
                mass, rows = kept[n - 1].get(tuple(tokens[i - n : i]), (1.0, {}))
                p = p * mass + rows.get(w, 0.0)
            score += math.log10(p)
        out.append((len(tokens), sum((w,) in grams[0] for w in tokens), total, base, score))
    return out


def test_suffix_tree_is_the_plain_one(spark, docs, empty):
    train = docs.where("doc_id % 2 = 1 OR doc_id = 10")
    model, counts = suffix_tree.fit(train)
    rows = suffix_tree.score(docs, model, counts).collect()
    texts = [r.text for r in docs.collect()]
    wanted = brute_scores([r.text for r in train.collect()], texts, suffix_tree.DEPTH, 0.0)
    got = sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows)
    assert np.allclose(got, sorted(wanted), atol=1e-9)
    none, no_words = suffix_tree.fit(empty)
    assert {r.base_score for r in suffix_tree.score(docs, none, no_words).collect()} == {0.0}
    assert suffix_tree.score(empty, model, counts).count() == 0


@pytest.mark.parametrize("parts", [1, 12])
def test_suffix_tree_does_not_depend_on_layout(spark, parts):
    """A line that stands once in each text, so in many partitions no sequence of it stands twice."""
    rows = [(i, f"a{i} b{i} licensed under the same terms as ever c{i}") for i in range(12)]
    train = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(parts, "doc_id")
    model, counts = suffix_tree.fit(train)
    got = sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in suffix_tree.score(train, model, counts).collect())
    texts = [t for _, t in rows]
    assert np.allclose(got, sorted(brute_scores(texts, texts, suffix_tree.DEPTH, 0.0)), atol=1e-9)


def test_suffix_tree_lists_what_occurs_twice_in_a_large_corpus(spark):
    """Two occurrences among five million tokens."""
    two = spark.createDataFrame([(1, "p q r s"), (2, "p q r s")], "doc_id long, text string")
    many = spark.range(10, 110).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x "), 50_000).alias("text"))
    model, counts = suffix_tree.fit(two.union(many))
    rows = suffix_tree.score(two, model, counts).collect()
    assert all(r.train_tokens > 5_000_000 and r.score > r.base_score + 5 for r in rows) and len(rows) == 2


def test_suffix_tree_leaves_sequences_to_the_executors(spark, docs, monkeypatch):
    """Neither the counts nor the model come to the driver or into a broadcast of its own."""

    def refuse(*_, **__):
        raise AssertionError("to or from the driver")

    for name in ("toArrow", "toPandas"):
        monkeypatch.setattr(type(docs), name, refuse)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", refuse)
    model, counts = suffix_tree.fit(docs)
    scored = suffix_tree.score(docs, model, counts)
    assert {type(v) for k, v in vars(model).items() if k != "table"} == {int}
    monkeypatch.undo()
    assert scored.count() == docs.count()


def drawn_texts(many, length):
    """Texts of words drawn unevenly, so that some sequences are common, and a line that stands in each."""
    rng = np.random.default_rng(8)
    return [" ".join([*(f"w{w}" for w in rng.zipf(1.3, length) % 5000), "one line for all of them"]) for _ in range(many)]


@pytest.mark.parametrize(("common", "crowd"), [(1 << 20, 40), (20, 1 << 20), (7, 25), (0, 30)])
def test_suffix_tree_with_few_ranks_and_small_places(spark, monkeypatch, common, crowd):
    """Words without a rank, words dealt over many places, and the training texts apart from or among the scored ones."""
    monkeypatch.setattr(suffix_tree, "COMMON", common)
    monkeypatch.setattr(suffix_tree, "CROWD", crowd)
    monkeypatch.setattr(suffix_tree, "_STRETCH", 300)
    texts = [*drawn_texts(40, 30), None, "", "never seen"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    trained = F.col("doc_id") % 4 != 0
    model, counts = suffix_tree.fit(docs.where(trained))
    wanted = sorted(brute_scores([t for i, t in enumerate(texts) if i % 4], texts, suffix_tree.DEPTH, 0.0))
    for option in ({}, {"trained": trained}):
        got = suffix_tree.score(docs, model, counts, **option).collect()
        got = sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
        assert np.allclose(got, wanted, atol=1e-9)


def test_suffix_tree_shuffles_no_sequence_on_its_own(spark):
    """A few bytes a token in some rows a task; counted and looked up one by one they were eight rows a token."""
    texts = [(i, t, 3) for i, t in enumerate(drawn_texts(400, 250))]
    docs = spark.createDataFrame(texts, "doc_id long, text string, use int").coalesce(2)
    model, counts = suffix_tree.fit(docs)
    common, _ = suffix_tree._common_words(counts, model)
    sent = suffix_tree._windows(docs, "doc_id", common, model.total).agg(F.count("*").alias("rows"), F.sum(F.length("blob")).alias("bytes")).first()
    assert sent["rows"] < model.tokens / 20 and sent["bytes"] < 10 * model.tokens


def test_suffix_tree_beats_the_base_on_held_out_texts(spark, sf_dir):
    rows = [r for r in QUERIES["op8_suffix_tree"](spark, sf_dir).collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


KEY = "bc0d31ba76f17e56642e8751295a3fd50cd8e61f"


def test_secrets_are_found_and_other_runs_kept(spark, empty):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        value = "".join(rng.choice(list("0123456789abcdef"), 40))
        number = "".join(rng.choice(list("0123456789"), 16))
        text = f'words and token = "{value}" more' if i % 2 else f"words and 4{number} or checksum sha256-{value} and MixedCaseIdentifierNumber{i}"
        rows.append((i, text, "src1"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    forest = secrets.fit(docs, path="source")
    new = [(1, f'a token = "{KEY}" b'), (2, f"checksum sha256-{KEY} and 4671234567890123"), (3, None), (4, ""), (5, f'api_key: "{KEY[:32]}", token = "{KEY}"')]
    found = {r.doc_id: r.secrets for r in secrets.scan(spark.createDataFrame(new, "doc_id long, text string"), forest).collect()}
    assert found[1].redacted == 'a token = "[SECRET]" b' and found[1].found[0] == (11, 51)
    assert found[2].found == [] and found[2].n_candidates == 2 and found[2].redacted == new[1][1]
    assert found[3].redacted is None and found[4].redacted == "" and found[3].found == []
    assert found[5].redacted == 'api_key: "[SECRET]", token = "[SECRET]"'
    assert secrets.scan(empty, secrets.fit(empty)).count() == 0


def test_planted_tokens_of_the_documents(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    import re

    planted = sum(len(re.findall(r'(?i)token = "[0-9a-f]{40}"', r.text)) for r in table(spark, sf_dir, "documents").collect())
    rows = QUERIES["op3_secret_forest"](spark, sf_dir).collect()
    assert sum(r.n_secrets for r in rows) == planted > 0
    assert sum(r.n_candidates for r in rows) > planted


RECORDS = [
    ('{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": null}]}', "messages", [("user", "a"), ("assistant", "")]),
    ('{"conversations": [{"from": "x\\\\ny", "value": "\\\\\\\\ <|im_end|>\\\\n|"}]}', "conversations", [("x\ny", "\\ <|im_end|>\n|")]),
    ('{"prompt": "p <|im_start|>assistant", "response": "r\\\\\\\\n"}', "prompt", [("user", "p <|im_start|>assistant"), ("assistant", "r\\n")]),
    ('{"instruction": "i", "input": "", "output": "o"}', "instruction_input", [("user", "i"), ("user", ""), ("assistant", "o")]),
    ('{"system": "s", "instruction": "i", "output": "STRING"}', "instruction_system", [("system", "s"), ("user", "i"), ("assistant", "STRING")]),
    ('{"messages": []}', "messages_empty", []),
    ('{"unknown": 1}', None, None),
    ("no json", None, None),
    (None, None, None),
]


def test_layouts_and_reversible_escapes(spark):
    records = spark.createDataFrame([(i, r[0].replace("\\\\", "\\") if r[0] else None) for i, r in enumerate(RECORDS)], "id int, record string")
    out = chat.format_chats(records).withColumn("turns", chat.read_turns(F.col("formatted"), F.col("turn_loss")))
    for r in out.collect():
        _, layout, turns = RECORDS[r.id]
        assert r.layout == layout
        if turns is None:
            assert r.formatted is None
        else:
            assert [(t.role, t.text) for t in r.turns] == turns
            assert r.formatted.count(chat.OPEN) == r.formatted.count(chat.CLOSE) == len(turns)
            assert r.turn_loss == [role == "assistant" for role, _ in turns]
            assert sum(r.turn_chars) == len(r.formatted)


def test_every_conversation_reads_back(spark, sf_dir):
    rows = {r.conv_id: r for r in QUERIES["op4_chat_format"](spark, sf_dir).collect()}
    turns: dict[int, list] = {}
    for r in sorted(table(spark, sf_dir, "conversations").collect(), key=lambda r: (r.conv_id, r.turn)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    said = "<|im_end|><|im_start|>assistant ok"
    turns[-1] = [("user", said), ("assistant", said)]
    assert set(rows) == set(turns)
    for key, own in turns.items():
        loss = "".join(t for role, t in own if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in own)
        r = rows[key]
        assert (r.n_turns, r.turns_sha256) == (len(own), sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha256(loss.encode()).hexdigest())


@pytest.mark.parametrize("name", ["op4_chat_format"])
def test_chat_formatting_runs_no_python(spark, sf_dir, name):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_chat_records_without_rows_and_with_clashing_names(spark):
    records = spark.createDataFrame([(1, '{"prompt": "a", "response": null}'), (1, '{"prompt": "a", "response": null}'), (2, None), (3, "{}"), (4, "no json")], "id long, record string")
    rows = chat.format_chats(records).collect()
    assert [r.layout is None for r in sorted(rows, key=lambda r: r.id)][:2] == [False, False]
    assert [r.formatted for r in rows if r.id in (2, 4)] == [None, None]
    assert len(rows) == 5
    assert chat.format_chats(records.limit(0)).count() == 0
    for name in ("layout", "formatted", "turn_loss", "_parts"):
        with pytest.raises(ValueError, match="exist"):
            chat.format_chats(records.withColumnRenamed("id", name))


def test_dictionary_does_not_depend_on_layout(spark, sf_dir, empty):
    docs = table(spark, sf_dir.replace("sf0.001", "sf0.01"), "documents").select("text")
    one = secrets.common_words(docs.coalesce(1))
    assert one == secrets.common_words(docs.repartition(100))
    count, total = Counter(), 0
    for r in docs.collect():
        own = words(r.text)
        total += len(own)
        count.update(w for w in own if len(w) >= 3 and w.isalpha())
    assert one == {secrets._word_hash(w.decode()) for w, n in count.items() if n >= max(2, 2e-5 * total)} and len(one) > 100
    assert secrets.common_words(empty) == frozenset()


def test_forest_scores_are_those_of_its_trees(spark):
    rng = np.random.default_rng(4)
    rows, labels = rng.standard_normal((300, 12)), rng.integers(0, 2, 300)
    forest = secrets.Forest(secrets.grow(rows, labels), 0.5, frozenset())

    def leaf(tree, row):
        at = 0
        while tree[0][at] >= 0:
            at = tree[2][at] if row[tree[0][at]] <= tree[1][at] else tree[3][at]
        return tree[4][at]

    new = rng.standard_normal((200, 12))
    assert np.allclose(forest.score(new), [np.mean([leaf(t, r) for t in forest.trees]) for r in new])


def test_dictionary_coverage_decides(spark):
    """Labels by hand that no published form restates: names put together from words of the texts are none, random letters of like form are secrets."""
    rng = np.random.default_rng(6)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    spoken = ["".join(rng.choice(letters, 6)) for _ in range(60)]

    def run(real):
        parts = ["".join(rng.choice(letters, 6)) for _ in range(4)] if real else rng.choice(spoken, 4)
        return "-".join(parts) + "7"

    def texts(first, number):
        return [(i, f"{' '.join(rng.choice(spoken, 12))} the value {run(i % 2)} stands here") for i in range(first, first + number)]

    docs = spark.createDataFrame(texts(0, 400), "doc_id long, text string")
    known = secrets.common_words(docs)
    hand = []
    for i, text in ((r.doc_id, r.text) for r in docs.collect()):
        for start, end in secrets.candidates(text):
            hand.append((i, i % 2, [float(x) for x in secrets.features(text, start, end, "", known)]))
    assert len(hand) == 400
    forest = secrets.fit(docs, spark.createDataFrame(hand, "mark long, label int, features array<float>"))
    new = spark.createDataFrame(texts(1000, 200), "doc_id long, text string")
    # none of the dictionary's words, so that coverage says nothing
    blind = secrets.Forest(forest.trees, forest.prior, frozenset())
    with_words = {r.doc_id: len(r.secrets.found) for r in secrets.scan(new, forest).collect()}
    without = {r.doc_id: len(r.secrets.found) for r in secrets.scan(new, blind).collect()}
    caught = sum(with_words[i] for i in with_words if i % 2)
    wrong = sum(with_words[i] for i in with_words if i % 2 == 0)
    assert caught >= 95 and wrong <= 5
    assert sum(without[i] for i in without if i % 2 == 0) > 50


def test_secrets_in_odd_rows(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (1, "word " * 300_000 + f'token = "{KEY}"'), (1, "")], "doc_id long, text string")
    forest = secrets.Forest(secrets.grow(np.zeros((4, secrets.FEATURES)), np.array([0, 1, 0, 1])), 0.5, frozenset())
    found = secrets.scan(docs, forest).collect()
    assert sorted(r.secrets.n_candidates for r in found) == [0, 0, 0, 1]
    with pytest.raises(ValueError):
        secrets.scan(docs.withColumn("secrets", docs.text), forest)


def plain_fingerprint(own, terms):
    """Part by part: the sum of the hashes of the distinct words that a subset holds, in 16 bits."""
    distinct = {int(secrets.span_hashes(np.frombuffer(w, np.uint8), np.zeros(1, np.int64), np.full(1, len(w)), lower=True)[0]) for w in own}
    kept = distinct & set(terms.tolist()) or distinct
    parts = []
    for seed, limit in zip(imatch._SEEDS.tolist(), imatch._LIMITS.tolist(), strict=True):
        marks = [int(imatch.mix(np.array([w ^ seed], np.uint64))[0]) for w in sorted(kept)]
        total = sum(int(imatch.mix(np.array([m + 1], np.uint64))[0]) for m in marks if m < limit) % 2**64
        parts.append(1 + (total >> 16) % 65535 if total else 0)
    return parts


def plain_likeness(a, b):
    shares, same, filled = [], 0, 0
    for s in range(0, len(a), imatch.SUBSETS):
        pairs = [(x, y) for x, y in zip(a[s : s + imatch.SUBSETS], b[s : s + imatch.SUBSETS], strict=True) if x or y]
        equal = sum(x == y for x, y in pairs)
        same, filled = same + equal, filled + len(pairs)
        if len(pairs) >= 8:
            shares.append(equal / len(pairs))
    return 1.0 if not filled else max(shares) if shares else same / filled


def test_fingerprints_and_likeness_are_the_plain_ones(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").where("doc_id < 40")
    texts = sorted((r.doc_id, r.text or "") for r in docs.collect())
    terms = imatch.lexicon(docs, math.log(1.5), math.log(30))
    found = {r.doc_id: r for r in imatch.compare_with_next(docs, terms).collect()}
    assert len(found) == len(texts) > 20
    marks = [plain_fingerprint(words(t), terms) for _, t in texts]
    for i, (key, text) in enumerate(texts):
        after, half = (i + 1) % len(texts), len(text) // 2
        edited = plain_fingerprint(words(text[: len(text) - half] + texts[after][1][:half]), terms)
        r = found[key]
        assert r.fingerprint == "".join(f"{p:04x}" for p in marks[i])
        assert r.edited_fingerprint == "".join(f"{p:04x}" for p in edited)
        assert (r.near_edited, r.near_next) == (pytest.approx(plain_likeness(marks[i], edited)), pytest.approx(plain_likeness(marks[i], marks[after])))


def test_quality_is_the_plain_vote(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    space = knn_quality.fit(docs, labels, "quality", per_class=40, rank=12)
    given = {r.doc_id: r.quality for r in labels.collect() if r.quality in (0, 1)}
    rows = knn_quality.score(docs, space).collect()
    assert len(space.vectors) <= 80 and len(rows) == docs.count()

    def vector(text):
        counts = knn_quality.term_counts(pa.array([text], pa.string()))[0].astype(float)
        weighed = [math.sqrt(c / max(1, counts[: knn_quality.WORD_TERMS].sum())) * i for c, i in zip(counts, space.idf.tolist(), strict=True)]
        v = np.array(weighed) @ space.axes
        return v / max(1e-12, math.sqrt((v * v).sum()))

    # a class's votes weigh as often as the class is labelled, not as often as it is sampled
    number = {y: sum(g == y for g in given.values()) for y in (0, 1)}
    sampled = {y: int((space.labels == y).sum()) for y in (0, 1)}
    texts = {r.doc_id for r in docs.collect()}
    for r in rows[:60]:
        own = vector(r.text)
        cosines = [(float(own @ v), y) for v, y in zip(space.vectors, space.labels.astype(int).tolist(), strict=True)]
        near = sorted(cosines, reverse=True)[: knn_quality.NEIGHBOURS]
        weight = [(max(c, 0.0) ** knn_quality.SHARPNESS * number[y] / sampled[y], y) for c, y in near]
        total = sum(w for w, _ in weight)
        wanted = sum(w for w, y in weight if y) / total if total else space.prior
        assert r.score == pytest.approx(wanted, abs=1e-4)
    assert set(given) & texts


def test_ties_across_classes_and_clashing_columns(spark):
    """Equal texts with unlike labels: each says what the share of its labels says."""
    rows = [(i, "the very same words in every text" if i < 8 else f"quite another number {i} of words ..") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    space = knn_quality.fit(docs, labels, "quality")
    found = {r.doc_id: r.score for r in knn_quality.score(docs, space).collect()}
    assert all(found[i] == pytest.approx(0.5) for i in range(8)) and len(found) == 12
    with pytest.raises(ValueError, match="exists"):
        knn_quality.score(docs.withColumn("score", docs.text), space)
