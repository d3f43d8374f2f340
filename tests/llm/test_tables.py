"""Edge cases of the operators on pages, conversations and vectors, and of the pipeline."""

import hashlib

import numpy as np
import pytest

import corpus_pipeline
from tallyhouse.llm import chat, fixity, near_vectors
from tallyhouse.llm.common import components

PAGES = "page_id long, url string, html string"


def test_equal_replicas_differ_in_nothing(spark):
    pages = spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (None, None, None), (9000, "v", "")], PAGES)
    rows = fixity.records(pages)
    assert fixity.audit(rows, rows).count() == 0
    assert fixity.audit(rows.limit(0), rows.limit(0)).count() == 0
    assert fixity.audit(rows, rows.limit(0)).count() == 3


def test_damage_is_located(spark):
    rows = [(k, f"u{k}", "body" * (k % 7)) for k in range(-40, 400)]
    other = [r if r[0] not in (5, 60) else (r[0], r[1], "bad") for r in rows if r[0] != 100] + [(7, "u7", ""), (7, "u7", "")]
    first, second = (fixity.records(spark.createDataFrame(x, PAGES)) for x in (rows, other))
    found = sorted((r.id, r.n_first, r.n_second) for r in fixity.audit(first, second).collect())
    assert found == sorted([(5, 1, 0), (5, 0, 1), (60, 1, 0), (60, 0, 1), (100, 1, 0), (7, 1, 3)])


def test_damage_leaves_other_branches_alone(spark):
    rows = fixity.records(spark.createDataFrame([(k, "u", "b" * k) for k in range(600)], PAGES))
    lost = fixity.records(spark.createDataFrame([(k, "u", "b" * k) for k in range(600) if k != 20], PAGES))
    order = fixity.places(rows.select("id").unionByName(lost.select("id")), "order")
    one, two = (fixity.levels(x, order, 3, n) for x, n in ((rows, "a"), (lost, "b")))
    for k in (1, 2):
        other = two[k].select("node", "hash", "bytes")
        assert one[k].select("node", "hash", "bytes").exceptAll(other).count() == 1


def test_ids_of_any_size(spark):
    ids = [-(1 << 63), (1 << 63) - 1, 0, -1, None, 1 << 40, 5] + [k * 92233720368547 for k in range(-300, 300, 7)]
    rows = [(k, f"u{k}", "body") for k in ids]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{PAGES}, node string, FILE int")
    other = spark.createDataFrame([(k, u, "bad" if k in (-(1 << 63), 1 << 40) else b) for k, u, b in rows if k != 5], PAGES)
    found = fixity.audit(fixity.records(frame), fixity.records(other)).collect()
    assert sorted((r.id, r.n_first, r.n_second, r.file) for r in found) == sorted(
        [(-(1 << 63), 1, 0, -(1 << 51)), (-(1 << 63), 0, 1, -(1 << 51)), (1 << 40, 1, 0, 1 << 28), (1 << 40, 0, 1, 1 << 28), (5, 1, 0, 0)]
    )
    order = {r.id: r.node for r in fixity.places(spark.createDataFrame(rows + rows[:3], PAGES).withColumnRenamed("page_id", "id"), "any").collect()}
    assert [order[k] for k in sorted(order, key=lambda k: (k is not None, k))] == list(range(len(set(ids))))


def test_spans_after_a_rewrite():
    def summed(turns, first):  # from the third turn on, a summary stands in front
        return ("SUMMARY;" if len(turns) > 2 else "") + "".join(t for _, t in turns)

    found = list(chat.spans(iter([("user", t) for t in ("aa", "Sb", "ccc", "d")]), summed))
    assert found == [("aa", 0, False), ("Sb", 2, False), ("SUMMARY;aaSbccc", 0, True), ("d", 15, False)]
    whole = summed([("user", t) for t in ("aa", "Sb", "ccc", "d")], 0)
    assert whole[found[3][1] :] == "d"

    def edited(turns, first):  # each turn changes the end of the one before
        return "".join(t + ("." if k == len(turns) - 1 else ",") for k, (_, t) in enumerate(turns))

    found = list(chat.spans(iter([("user", t) for t in ("one", "two", "six")]), edited))
    assert found == [("one.", 0, False), (",two.", 3, True), (",six.", 7, True)]


def test_chat_round_trip(spark):
    said = ["", "\\", "</s>", "<\\s>", "[INST] x [/INST]", "<s><s>", "[ROLE] user [/ROLE]", "a\n\\\\</s", "é" * 3]
    rows = [(c, t, r, x) for c, x in enumerate(said) for t, r in enumerate(["system", "user", "assistant", "user", "assistant", None, "</s>"])]
    rows += [(50, k, "user", f"t{k}") for k in range(100)] + [(None, None, "assistant", None), (None, 1, "user", "x"), (None, 1, "user", "x")]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(chats)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256, got[conv].loss_chars) == (len(turns), digest, len(loss))
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and got[conv].rewrites == 0


def test_rewriting_templates_are_found():
    def last_marked(turns, first):
        return "".join(f"<{t}>" if k < len(turns) - 1 else f"[{t}]" for k, (_, t) in enumerate(turns))

    flags = [rewrites for _, _, rewrites in chat.spans(iter([("user", "a"), ("user", "b"), ("user", "c")]), last_marked)]
    assert flags == [False, True, True]


def test_rewrites_are_found_on_the_whole_prefix():
    turns = [("user", f"t{k}") for k in range(70)]

    def plain(turns, first):
        return "".join(f"<{t}>" for _, t in turns)

    def summary(turns, first):  # rewrites all when turn 33 comes
        return ("(summary)" if first + len(turns) > 32 else "") + plain(turns, first)

    def far(turns, first):  # marks the first turn when the 50th comes
        return "".join(f"<{t}>" if k or first + len(turns) != 50 else f"[{t}]" for k, (_, t) in enumerate(turns))

    def found(template, local=False):
        return [k for k, (_, _, rewrites) in enumerate(chat.spans(iter(turns), template, local)) if rewrites]

    assert found(summary) == [32]
    assert found(far) == [49, 50]
    assert found(plain) == []
    # The template of the query is local.
    turns = [(("system", "user", "assistant")[k % 3], f"</s>t{k}") for k in range(70)]
    assert list(chat.spans(iter(turns), chat.inst_template)) == list(chat.spans(iter(turns), chat.inst_template, True))


def test_the_chat_query_renders_every_prefix_from_the_first_turn(spark, tmp_path, monkeypatch):
    plain = chat.inst_template

    def from_the_first(turns, first):
        if first or (turns[0][1] != "0" and not turns[0][1].startswith("</s>")):
            raise ValueError("not a prefix of the conversation")
        return plain(turns, first)

    rows = [(1, k, "assistant" if k % 2 else "user", str(k)) for k in range(70)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats.write.parquet(str(tmp_path / "conversations.parquet"))
    monkeypatch.setattr(chat, "inst_template", from_the_first)
    got = {r.conv_id: (r.n_turns, r.loss_chars, r.rewrites) for r in chat.op3_chat_formatting(spark, str(tmp_path)).collect()}
    assert got == {1: (70, sum(len(str(k)) for k in range(1, 70, 2)), 0), -7: (2, 21, 0)}


def brute(vectors):
    n = len(vectors)
    links, component = [0] * n, list(range(n))

    def root(k):
        while component[k] != k:
            k = component[k]
        return k

    for a in range(n):
        for b in range(a):
            (la, x), (lb, y) = vectors[a], vectors[b]
            if la == lb and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links[a] += 1
                links[b] += 1
                low, high = sorted((root(a), root(b)))
                component[high] = low
    return [(links[k], root(k)) for k in range(n)]


def test_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    random = np.random.default_rng(5)
    vectors = []
    for label in (1, 2):
        for _ in range(12):
            base = random.standard_normal(24)
            vectors += [(label, (base + random.standard_normal(24) * random.choice([0.0, 0.1, 0.2, 0.35])).astype(np.float32).astype(float)) for _ in range(10)]
    rows = [(k, v.tolist(), label) for k, (label, v) in enumerate(vectors)]
    odd = [(900, None, 1), (901, [], 1), (902, [0.0] * 24, 1), (903, [float("nan")] * 24, 1), (904, [None] * 24, 1), (905, vectors[0][1].tolist(), None), (906, [1.0, 2.0], 1), (907, [float("inf")] * 24, 2)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_vectors(frame).collect()}
    want = dict(enumerate(brute(vectors)))
    assert {k: got[k] for k in want} == want and all(got[k[0]] == (0, k[0]) for k in odd)
    assert near_vectors.near_vectors(frame.limit(0)).count() == 0


def test_vectors_at_the_threshold_in_blocks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 64)
    random = np.random.default_rng(11)
    rows = []
    for k in range(400):
        a, b = np.linalg.qr(random.standard_normal((64, 2)))[0].T
        rows += [(2 * k, a.tolist(), 1), (2 * k + 1, (0.9300001 * a + np.sqrt(1 - 0.9300001**2) * b).tolist(), 1)]
    got = near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert len(got) == 800 and all((r.n_links, r.component_id, r.kept) == (1, r.vec_id // 2 * 2, r.vec_id % 2 == 0) for r in got)


def test_vectors_of_extreme_lengths_repeats_and_clashing_columns(spark):
    vectors = [[1e200, 1e200], [1.0, 1.0], [1e-200, 1e-200], [5e-324, 0.0], [3.0, 0.0], [-3.0, 0.0], [1.0, 1.0], [1.7e308, 0.0]]
    rows = [(k, v, 1, "x", 1, "y") for k, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, c string, salt int, root string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_vectors(frame).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 6: (3, 0), 3: (2, 3), 4: (2, 3), 7: (2, 3), 5: (0, 5)}


def test_estimates_hold_their_bounds():
    random = np.random.default_rng(1)
    unit = random.standard_normal((300, 64))
    unit /= np.sqrt((unit**2).sum(1, keepdims=True))
    rotated, bits, factor = near_vectors.codes(unit)
    estimate = rotated @ ((2.0 * bits - 1) / np.sqrt(rotated.shape[1])).T / factor
    off = ~np.eye(300, dtype=bool)
    error = (estimate - unit @ unit.T)[off]
    assert abs(error.mean()) < 0.005 and np.abs(error).max() < near_vectors.ERROR * np.sqrt(0.6 / 255)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (300, 301), (301, 300)]
    rows = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert len({rows[k] for k in range(61)}) == 1 and len({rows[k] for k in range(100, 140)}) == 1 and rows[300] == rows[301]
    assert len(set(rows.values())) == 3


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    last = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in last} <= ids and len({r.doc_id for r in last}) > 100
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, folder)
        assert out.columns == docs.columns and out.count() == 0
