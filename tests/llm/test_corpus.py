"""Operators that learn from or search the whole table: hard negatives, aligned tokenizers, sequence scores."""

import math
import random
from zlib import crc32

import brute
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from souqframe.llm import chunks, decontaminate, hard_negatives, hidden_markov, sequence_score, token_alignment
from souqframe.llm.queries import PIECES, WORDS, queries

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"
EDGE = [None, "", " \t\n", "a", "é\n\n日本語 😀 '", "  two  blanks ", "word " * 3_000, "x" * 20_000, "same same", "same same",
        "a ▁ b", "<|endoftext|> <s> <0x41> \x00", "Don't stop, ... it 'ReaLly' is 12345 67"]


# --- hard negatives ----------------------------------------------------------------------------------


def _mined(df, tmp_path):
    found = hard_negatives.mine_hard_negatives(
        df, F.col("id") % 100 == 0, str(tmp_path / "m"), label=F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    )
    return sorted(map(tuple, found.collect()))


def test_hard_negatives_of_random_vectors(spark, tmp_path, monkeypatch):
    # Several blocks a task, several groups of anchors, many ties and repeated vectors.
    monkeypatch.setattr(hard_negatives, "SENT", 100)
    monkeypatch.setattr(hard_negatives, "BLOCK", 97)
    monkeypatch.setattr(hard_negatives, "FEW", 4)
    rnd, rows = random.Random(5), []
    for id in range(1200):
        vector = [round(rnd.gauss(0.05, 0.2), rnd.choice([1, 7])) for _ in range(20)]
        rows.append((id, vector if rnd.random() < 0.7 or not rows else rows[rnd.randrange(len(rows))][1], rnd.randrange(4)))
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    exact = [(r["vec_id"], r["label"], list(map(float, r["embedding"]))) for r in df.collect()]
    found = _mined(df, tmp_path)
    assert found == brute.hard_negatives(exact)
    assert len(found) > 100


def test_hard_negatives_on_edge_cases(spark, tmp_path):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (100, [0.0, 0.0], 2), (200, [], 2), (300, None, 2), (400, [1.0, None], 2),
        (500, [nan, 1.0], 2), (600, [inf, 1.0], 2), (800, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (900, [-1.0, -0.5], 2),
        (1, [1.0, 0.5], 2), (2, [1.0, 0.5], 2), (2, [1.0, 0.5], 2), (3, [0.9, 0.5], 1), (4, [0.9], 2), (5, [0.9], 1),
        (6, [0.7, 0.5, 9.0], 2), (7, [0.8, 0.5], 1), (8, [-0.004, 0.0], 1), (9, [0.8, 0.5], 3),
    ]
    df = spark.createDataFrame(rows, VECTORS).withColumn("place", F.lit(1)).withColumn("top", F.lit("x"))
    assert _mined(df, tmp_path / "a") == brute.hard_negatives([(i, label, v) for i, v, label in rows])
    assert _mined(df.where("vec_id % 100 > 0"), tmp_path / "b") == []
    assert _mined(df.limit(0), tmp_path / "c") == []
    with pytest.raises(Exception, match="component"):
        _mined(spark.createDataFrame([(0, [1e30], 1)], VECTORS), tmp_path / "d")


def test_scan_reads_few_columns_of_most_rows():
    # Where the first dimension decides, the bounds leave few candidates for the others.
    rnd = np.random.default_rng(1)
    matrix = rnd.integers(-20, 20, (4000, 32)).astype(np.int32)
    matrix[:, 3] = rnd.integers(-9000, 9000, 4000)
    block = hard_negatives.Block(
        np.arange(4000), np.zeros(4000, np.int64), list(matrix.T.copy()), matrix.min(axis=0), matrix.max(axis=0)
    )
    vector, left = np.full(32, 2), []
    vector[3] = 90
    anchor = hard_negatives.Anchor(0, -1, 0, vector, np.empty(0, np.int64))
    assert hard_negatives.Order(vector, block).dimensions[0] == 3

    def in_reach(low, high):
        assert (low <= high).all()
        left.append(high >= np.sort(low)[-5])
        return left[-1]

    alive, scores = hard_negatives.scan(anchor, block, np.arange(4000), in_reach)
    assert left[0].sum() < 100
    assert (scores == matrix[alive] @ vector).all()
    assert set(np.argsort(-(matrix @ vector))[:5]) <= set(alive.tolist())


# --- aligned tokenizers ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    return token_alignment.ByteTokens(P.path(WORDS)), token_alignment.PieceTokens(P.path(PIECES))


def _plain(texts, tokenizers):
    a, b = tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.path(WORDS))
    whole.encode_special_tokens = True
    return brute.alignments(
        texts,
        lambda text: whole.encode(text, add_special_tokens=False).ids, a.bytes.__getitem__,
        b.processor.encode, b.bytes.__getitem__,
    )


NAMES = [*token_alignment.MEASURES, "n_best", "count_sum", "groups_sha256"]


def test_alignment_of_edge_cases(docs, by_id, tmp_path, tokenizers):
    df = docs(EDGE).withColumn("n_best", F.lit("x")).withColumn("chunk", F.lit(1)).withColumn("digest", F.lit(None))
    found = by_id(
        token_alignment.align_tokenizers(
            df, P.path(WORDS), P.path(PIECES), str(tmp_path / "a"), keep=["doc_id", "n_best", "chunk"]
        )
    )
    assert [tuple(found[i][name] for name in NAMES) for i in range(len(EDGE))] == _plain(EDGE, tokenizers)
    assert found[0]["n_a"] == found[1]["n_a"] == found[EDGE.index("a ▁ b")]["n_a"] == 0
    empty = token_alignment.align_tokenizers(docs([]), P.path(WORDS), P.path(PIECES), str(tmp_path / "b"))
    assert empty.collect() == []


def test_alignment_query(spark, by_id, tokenizers, monkeypatch):
    monkeypatch.setattr(token_alignment, "CHUNK", 5_000)  # several chunks
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = by_id(queries()["op12_token_alignment"](spark, SF))
    plain = _plain([row["text"] for row in rows], tokenizers)
    assert [tuple(found[row["doc_id"]][name] for name in NAMES) for row in rows] == plain
    assert len(found) == len(rows)


def test_alignment_forgets_and_goes_on(tokenizers, monkeypatch):
    monkeypatch.setattr(token_alignment, "PARTS", 3)
    aligner, parts = token_alignment.Aligner(*tokenizers), ["one", "two", "x" * 100, "three", "one", "four▁", "", "\x00"] * 3
    assert aligner.of(parts) == [aligner.align([part])[0] for part in parts] == aligner.align(parts)
    for part in parts:
        assert aligner.of([part]) == aligner.align([part])


def test_new_parts_of_many_texts_are_aligned_at_once(tokenizers, monkeypatch):
    monkeypatch.setattr(token_alignment, "TOGETHER", 500)
    texts = [f"word{n} other{n} e{n}" for n in range(400)] + ["a ▁ b", " “x” 東京 ", "東京 x y", "one  two\n three"]
    aligner, calls, together = token_alignment.Aligner(*tokenizers), [], token_alignment.Aligner._together
    monkeypatch.setattr(
        token_alignment.Aligner, "_together", lambda self, parts: calls.append(len(parts)) or together(self, parts)
    )
    chunk = token_alignment._Texts(aligner)
    for text in texts:
        chunk.add(text, 1)
    row = chunk.row()
    assert len(calls) < 40 and sum(calls) < 3 * 1200
    plain = _plain(texts, tokenizers)
    found = zip(*[row[name].tolist() for name in token_alignment.MEASURES], row["groups_sha256"], strict=True)
    assert [*found] == [(*whole[:4], whole[-1]) for whole in plain]


def test_ranks_give_the_same_tokens(tokenizers):
    a, rnd = tokenizers[0], random.Random(3)
    assert a.by_rank is not None
    letters = "abcABC'  \n\t.,;:!?0123456789éßñÄ²½ºµ-_/\\\"“”…" + "the and of "
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 40)))
        assert not token_alignment.ODD.search(text)
        whole = a.tokenizer.encode(f" {text}", add_special_tokens=False).ids
        assert a.encode(text) == whole, text


# --- sequence scores ---------------------------------------------------------------------------------


def _random_model(states=3, symbols=4):
    rnd = np.random.default_rng(2)
    first, moves, shown = rnd.random(states), rnd.random((states, states)), rnd.random((symbols, states))
    return hidden_markov.Model(first / first.sum(), moves / moves.sum(axis=1, keepdims=True), shown / shown.sum(axis=0))


@pytest.mark.parametrize(("every", "stretch", "group"), [(8, 1 << 19, 1 << 19), (2, 5, 12), (1, 1, 1)])
def test_markov_counts_and_likelihoods(monkeypatch, every, stretch, group):
    monkeypatch.setattr(hidden_markov, "EVERY", every)
    monkeypatch.setattr(hidden_markov, "STRETCH", stretch)
    monkeypatch.setattr(hidden_markov, "GROUP", group)
    model, rnd = _random_model(), random.Random(1)
    sequences = [[rnd.randrange(4) for _ in range(rnd.choice([1, 1, 2, 3, 5, 8]))] for _ in range(25)]
    symbols, lengths = np.array(sum(sequences, [])), np.array(list(map(len, sequences)))
    plain = [math.log(brute.markov_likelihood(model.first, model.moves, model.symbols, s)) for s in sequences]
    assert np.allclose(hidden_markov.likelihoods(model, symbols, lengths), plain)
    counts = hidden_markov.Counts.none(3, 4)
    hidden_markov.count(model, symbols, lengths, counts)
    expected = hidden_markov.Counts.none(3, 4)
    for sequence in sequences:
        begun, moved, shown = brute.markov_counts(model.first, model.moves, model.symbols, sequence)
        for target, found in ((expected.first, begun), (expected.moves, moved), (expected.symbols, shown)):
            for key, value in found.items():
                target[key] += value
    assert np.allclose(counts.first, expected.first) and np.allclose(counts.moves, expected.moves)
    assert np.allclose(counts.symbols, expected.symbols) and math.isclose(counts.likelihood, sum(plain))


def test_markov_training_only_gets_likelier():
    rnd = np.random.default_rng(3)
    lengths = rnd.integers(1, 60, 80)
    symbols = np.concatenate([rnd.integers(0, 3, n) + 3 * (i % 2) for i, n in enumerate(lengths)])
    model, before = hidden_markov.start(np.bincount(symbols, minlength=6), 2), -math.inf
    for _ in range(15):
        counts = hidden_markov.Counts.none(2, 6)
        hidden_markov.count(model, symbols, lengths, counts)
        assert counts.likelihood >= before - 0.2  # what is added to the counts may take a little
        before, model = counts.likelihood, hidden_markov.estimate(counts)
    # Each state ends up with the symbols of one kind of sequence.
    assert sorted(model.symbols[:3].sum(axis=0).round(1).tolist()) == [0.0, 1.0]


def test_markov_long_sequence_stays_in_range():
    model, long = _random_model(), np.tile(np.arange(4), 60_000)
    found = hidden_markov.likelihoods(model, long, np.array([len(long)]))[0]
    assert math.isfinite(found) and found < -200_000


def _scored(df, tmp_path, **more):
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(True))
    return sequence_score.score_texts(df, held_out, str(tmp_path), **more)


def test_sequence_scores_on_edge_cases(docs, by_id, tmp_path):
    texts = [*EDGE, *[f"Some {i % 7} words Of text {i % 3}" for i in range(40)]]
    df = docs(texts).withColumn("score", F.lit("x")).withColumn("WORDS", F.lit(1)).withColumn("ids", F.lit(2))
    found = by_id(_scored(df, tmp_path / "a", keep=["doc_id", "score", "WORDS", "ids"], classes=64, states=2, rounds=2))
    held_out = [crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    for i, plain in enumerate(brute.unigram_scores(texts, held_out)):
        row = found[i]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["held_out"]) == (*plain[:3], held_out[i])
        assert math.isclose(row["base_score"], plain[3], rel_tol=1e-9)
        assert math.isfinite(row["score"]) and row["score"] < 0
        assert (row["WORDS"], row["ids"]) == (1, 2)
    assert _scored(docs([]), tmp_path / "b").collect() == []
    # Nothing to learn from: all texts are held out, and every word is the unknown one of its class.
    nothing = by_id(_scored(docs(["a b", None]).withColumn("doc_id", F.lit(None).cast("long")), tmp_path / "c", classes=9))
    assert set(nothing) == {None}
    row = nothing[None]
    assert (row["train_tokens"], row["n_known"], row["base_score"]) == (0, 0, 0)
    assert math.isclose(row["score"], -row["n_tokens"] * math.log10(10))


def test_sequence_score_is_that_of_its_parts(spark, by_id, tmp_path, monkeypatch):
    # Over several chunks: the same as a plain forward pass over classes and counts of words within them.
    monkeypatch.setattr(sequence_score, "CHUNK", 300)
    texts = [f"{'der die das' if i % 2 else 'the a an'} w{i % 5} w{i % 3} x{i}" for i in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = by_id(_scored(df, tmp_path, classes=16, states=2, rounds=3))
    words = [text.encode().split() for text in texts]
    taught = [crc32(str(i).encode()) % 10 != 0 for i in range(len(texts))]
    of_word = {}
    for text, yes in zip(words, taught, strict=True):
        for word in text if yes else ():
            of_word[word] = of_word.get(word, 0) + 1
    of_class = np.zeros(17)
    for word, n in of_word.items():
        of_class[crc32(word) % 16] += n
    of_class[16] = sum(taught)
    coded = [[crc32(word) % 16 for word in text] + [16] for text in words]
    model = hidden_markov.start(of_class, 2)
    learned = [text for text, yes in zip(coded, taught, strict=True) if yes]
    for _ in range(3):
        counts = hidden_markov.Counts.none(2, 17)
        hidden_markov.count(model, np.array(sum(learned, [])), np.array(list(map(len, learned))), counts)
        model = hidden_markov.estimate(counts)
    kinds = np.bincount([crc32(word) % 16 for word in of_word], minlength=17)
    for i, text in enumerate(words):
        score = hidden_markov.likelihoods(model, np.array(coded[i]), np.array([len(coded[i])]))[0] / math.log(10)
        for word in text:
            number = crc32(word) % 16
            score += math.log10((of_word.get(word, 0) + 0.1) / (of_class[number] + 0.1 * (kinds[number] + 1)))
        assert math.isclose(found[i]["score"], score, rel_tol=1e-6)  # counts are sent with 24 bits


def test_sequence_scores_beat_independent_words(spark):
    found = queries()["op13_sequence_score"](spark, "/root/testdata/sf0.01").where("held_out")
    score, base = found.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > base


def test_chunks_take_every_row_in_order(spark):
    import pyarrow as pa

    class Two:
        def __init__(self):
            self.seen = []

        def add(self, value):
            self.seen.append(value)
            return value

    batch = [pa.RecordBatch.from_arrays([pa.array(range(i, i + 4)), pa.array([1, 2, 3, 4])], ["k", "v"]) for i in (0, 4)]
    found = [(collector.seen, kept.to_pylist()) for collector, kept in chunks.gather(iter(batch), 5, Two)]
    assert found == [([1, 2, 3], [0, 1, 2]), ([4, 1], [3, 4]), ([2, 3], [5, 6]), ([4], [7])]


# --- decontamination -------------------------------------------------------------------------------


def _benchmark(rnd, vocabulary, count):
    return [" ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 7, 8, 12, 20, 41]))) for _ in range(count)]


def _altered(rnd, vocabulary, words, changes):
    words = list(words)
    for _ in range(changes):
        at = rnd.randrange(len(words))
        kind = rnd.randrange(3)
        words[at : at + (kind != 1)] = [] if kind == 0 else [rnd.choice(vocabulary)]
        words = words or ["x"]
    return words


@pytest.mark.parametrize("sent_bytes", [8 << 20, 0])
def test_decontamination_is_that_of_all_distances(spark, docs, by_id, monkeypatch, sent_bytes):
    # Once with the test set sent around, once by a join: the same as edit distances of all pairs.
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", sent_bytes)
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(40)] + ["日", "本", "語"]
    items = _benchmark(rnd, vocabulary, 40)
    texts = [None, "", " . "]
    for _ in range(120):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(60))]
        for item in rnd.sample(items, rnd.randrange(3)):
            own = item.split()
            at = rnd.randrange(len(words) + 1)
            words[at:at] = _altered(rnd, vocabulary, own, rnd.randrange(len(own) // 4 + 2))
        texts.append(" ".join(words).replace(" w1 ", ", W1! "))
    rows = [(i % 37 if i < 37 else 900 + i, text) for i, text in enumerate(items)] + [(None, "w1"), (7, None), (8, " ")]
    rows += [(3, items[5])]  # an id with two texts
    table = spark.createDataFrame(rows, "item_id long, text string")
    df = docs(texts).withColumn("item_ids", F.lit("x")).withColumn("hits", F.lit(1)).withColumn("row", F.lit(2))
    found = by_id(decontaminate.contaminated(df, table, keep=["doc_id", "item_ids", "hits", "row"]))
    for i, text in enumerate(texts):
        words, expected = decontaminate.words_of(text), set()
        for id, item in rows:
            own = decontaminate.words_of(item)
            errors = int(len(own) * decontaminate.MOST_CHANGED) if len(own) >= decontaminate.LEAST_WORDS else 0
            if id is not None and own and brute.edit_places(own, words) <= errors:
                expected.add(id)
        assert found[i]["item_ids"] == sorted(expected), text
        assert (found[i]["hits"], found[i]["row"]) == (1, 2)
    assert sum(bool(row["item_ids"]) for row in found.values()) > 40
    assert decontaminate.contaminated(docs([]), table).collect() == []
    none = decontaminate.contaminated(docs(["w1 w2"]), table.where("false")).collect()
    assert [row["item_ids"] for row in none] == [[]]


def test_decontamination_by_join_reads_the_texts_once(spark, docs, monkeypatch, tmp_path):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 0)
    items = spark.createDataFrame([(i, f"only item {i} has these words in this order, item {i}") for i in range(300)], "item_id long, text string")
    texts = [f"before {item['text']} after" for item in items.limit(20).collect()] + ["nothing to find"] * 20
    result = decontaminate.contaminated(docs(texts), items, folder=str(tmp_path))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "LogicalRDD" not in plan and "Scan ExistingRDD" not in plan  # the texts themselves are not read again
    assert sum(row["item_ids"] != [] for row in result.collect()) == 20
