"""Pseudo-likelihood and quality model: against plain versions, held-out rows and edge cases."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from episodica.llm import pseudo_likelihood as lm
from episodica.llm import quality
from episodica.llm.queries import op9_quality_gam


def plain_log_prob(network, ids):
    """Token by token, as the definition says."""
    line = [0] * lm.REACH + list(ids) + [0] * lm.REACH
    total = 0.0
    for i in range(lm.REACH, len(line) - lm.REACH):
        places = [line[i + k] for k in range(-lm.REACH, lm.REACH + 1) if k]
        h = np.tanh(network.bias + sum(network.tables[p][t] for p, t in enumerate(places)))
        g, w = divmod(line[i], lm.GROUPS)
        for logits, at in ((h @ network.group + network.group_bias, g), (h @ network.within[g] + network.within_bias[g], w)):
            e = np.exp(logits.astype(float) - logits.max())
            total += np.log(e[at] / e.sum())
    return total


def test_network_learns_and_scores_as_defined(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.col("doc_id") % 5 == 0
    words, network = lm.fit(docs.where(~held), rounds=2)
    got = {r.doc_id: r for r in lm.score(docs.where(held), words, network).collect()}
    texts = {r.doc_id: r.text for r in docs.where(held).collect()}
    assert set(got) == set(texts)
    for doc_id, text in list(texts.items())[:20]:
        assert abs(got[doc_id].log_prob - plain_log_prob(network, words.ids(text))) < 1e-3 * max(1, got[doc_id].n_tokens)
    # Held-out texts are likelier than under the words' own shares.
    train = np.concatenate([words.ids(r.text) for r in docs.where(~held).select("text").collect()])
    share = np.log((np.bincount(train, minlength=lm.IDS) + 1.0) / (len(train) + lm.IDS))
    tokens = sum(r.n_tokens for r in got.values())
    unigram = sum(share[words.ids(t)].sum() for t in texts.values()) / tokens
    assert sum(r.log_prob for r in got.values()) / tokens > unigram + 0.05


def test_scoring_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "one"), (5, "w x " * 60_000), (6, "one"), (6, "one")]
    df = spark.createDataFrame([(*r, "a", 1.0) for r in rows], "doc_id long, text string, word string, log_prob double")
    words, network = lm.fit(df)
    got = {r.doc_id: (r.n_tokens, r.log_prob, r.mean_log_prob) for r in lm.score(df, words, network).collect()}
    assert got[1] == got[2] == got[3] == (0, 0.0, None)
    assert got[5][0] == 120_000 and got[5][1] < 0 and got[4] == got[6]
    assert lm.score(df, words, network).count() == 7
    empty = df.limit(0)
    assert lm.score(empty, *lm.fit(empty)).count() == 0


def test_words_of_one_class_are_told_apart(spark):
    """The probability of a word, not of its hash class, from counts of all words."""
    frequent = " ".join(f"w{i}" for i in range(768)) + " "
    texts = [frequent * 9, "common " * 8 + "seldom " * 2 + "once"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = lm.counted(docs)
    words, network = lm.fit(docs, counts=counts)
    assert {r.word: r.n for r in counts.where("n < 9").collect()} == {"common": 8, "seldom": 2, "once": 1}
    more = [(5, "common"), (6, "seldom"), (7, "w3 once"), (8, "never"), (8, "never"), (9, None), (10, "w3")]
    asked = spark.createDataFrame(more, "doc_id long, text string")
    plain = {r.doc_id: r.log_prob for r in lm.score(asked, words, network).collect()}
    rows = lm.score(asked, words, network, counts).collect()
    got = {r.doc_id: r.log_prob for r in rows}
    assert len(rows) == 7 and [r.log_prob for r in rows].count(got[8]) == 2
    assert got[9] == 0 and got[10] == plain[10]
    count = {"common": 8, "seldom": 2, "once": 1}
    for doc_id, word in ((5, "common"), (6, "seldom"), (7, "once"), (8, "never")):
        mates = [w for w in count if words[w] == words[word]]
        once = sum(count[w] == 1 for w in mates) + 1
        total = sum(count[w] for w in mates) + once
        own = count.get(word, once / (len(mates) + 1))
        assert np.isclose(got[doc_id] - plain[doc_id], np.log(own / total))
    assert lm.score(asked.limit(0), words, network, counts).count() == 0


def test_words_whose_counts_are_joined_score_as_those_held(spark, monkeypatch):
    texts = [" ".join(f"w{i * k % 1500}" for i in range(k, 900)) for k in range(1, 12)]
    docs = spark.createDataFrame([*enumerate(texts), (99, None), (99, "w3 never w3")], "doc_id long, text string")
    counts = lm.counted(docs.where("doc_id < 99"))
    words, network = lm.fit(docs, rounds=1, counts=counts)
    held = {(r.doc_id, r.n_tokens): r.log_prob for r in lm.score(docs, words, network, counts).collect()}
    monkeypatch.setattr(lm, "SHARED", 40)
    joined = {(r.doc_id, r.n_tokens): r.log_prob for r in lm.score(docs, words, network, counts).collect()}
    assert held.keys() == joined.keys() and all(np.isclose(held[k], joined[k]) for k in held)


def test_slopes_are_those_of_the_loss():
    """One step moves every parameter against its numeric slope; ids that no window names stay."""
    rng = np.random.default_rng(2)
    size = lm.GROUPS * 4
    target, window = lm.windows([rng.integers(1, size // 2, 40) for _ in range(5)])
    for bias in (0.0, 200.0):
        net = lm.WindowNetwork.start(np.ones(size))
        net.group_bias[0] += bias
        before = lm.WindowNetwork(*[p.copy() for p in net.parts()])
        square = [np.zeros(p.shape) for p in net.parts()]
        net.train(target, window, square)
        for k, (old, sums) in enumerate(zip(before.parts(), square, strict=True)):
            for at in [tuple(rng.integers(0, n) for n in old.shape) for _ in range(15)]:
                kept, loss = old[at], []
                for step in (1e-2, -1e-2):
                    old[at] = kept + step
                    loss.append(-before.log_prob(target, window).mean())
                old[at] = kept
                assert abs(abs(loss[0] - loss[1]) / 2e-2 - np.sqrt(sums[at])) < 2e-3, (bias, k, at)
        assert np.array_equal(net.tables[:, size // 2 :], before.tables[:, size // 2 :])


def test_pieces_add_up_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN", 3)
    rows = [(part, piece, np.array([part, piece, 1.0]).tobytes()) for part in range(20) for piece in range(3)]
    got = lm.summed(spark.createDataFrame(rows, lm.PIECES)).collect()
    assert {r.piece: np.frombuffer(r.value).tolist() for r in got} == {p: [190.0, 20.0 * p, 20.0] for p in range(3)}
    assert lm.summed(spark.createDataFrame([], lm.PIECES)).count() == 0


def test_ids_grow_with_the_distinct_words(spark):
    assert lm.ids_for(0) == lm.IDS and lm.ids_for(4_000_000) == 4000
    docs = spark.createDataFrame([(k, " ".join(f"v{i}" for i in range(k * 30_000, (k + 1) * 30_000))) for k in range(12)], "doc_id long, text string")
    words, network = lm.fit(docs, rounds=1)
    assert words.size == lm.ids_for(360_000) > lm.IDS and network.tables.shape[1] == words.size == network.group.shape[1] * lm.GROUPS
    got = lm.score(docs.where("doc_id = 1"), words, network).first()
    assert abs(got.log_prob - plain_log_prob(network, words.ids(docs.where("doc_id = 1").first().text))) < 1e-3 * got.n_tokens


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = op9_quality_gam(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(out) > 50
    assert np.mean([r.predicted == r.quality for r in out]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_tables_add_up():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(quality.FEATURES)))
    # An interaction that no sum of single features gives.
    y = ((x[:, 0] > 0) != (x[:, 1] > 0)).astype(float)
    m = quality.fit(x, y)
    assert (0, 1) in m.pairs
    assert np.mean((m.score(x) >= 0.5) == y) > 0.9
    b, c = m.bins(x, m.edges), m.bins(x, m.pair_edges)
    z = m.intercept + sum(m.tables[j][b[7, j]] for j in range(x.shape[1]))
    z += sum(t[c[7, i], c[7, j]] for (i, j), t in zip(m.pairs, m.pair_tables))
    assert np.isclose(m.score(x[7:8])[0], 1 / (1 + np.exp(-z)))


def test_quality_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b c " * 50_000), (4, "x"), (4, "x"), (5, "!!!")]
    docs = spark.createDataFrame([(*r, 0.0, "p") for r in rows], "doc_id long, text string, score double, predicted string")
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (4, None), (5, 0), (None, 1)], "doc_id long, quality int")
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        model = quality.fit(*quality.training_rows(docs, known, F.lit(True)))
        out = quality.score(docs, model, ["doc_id"])
        got = out.collect()
        assert out.columns == ["doc_id", "score", "predicted"] and len(got) == 6
        assert all(0 <= r.score <= 1 for r in got)
    assert quality.score(docs.limit(0), model, ["doc_id"]).count() == 0
    x, y = quality.training_rows(docs, labels, F.lit(True))
    assert sorted(y.tolist()) == [0.0, 1.0]  # 3 is labelled both ways
    assert len(quality.training_rows(docs, labels, F.lit(True), rows=1)[1]) == 1


def test_steps_are_even_and_whole():
    """No step is left with a few tokens, which costs as much as a full one."""
    for n in (0, 1, lm.BATCH, 2 * lm.BATCH + 300, 5 * lm.BATCH - 1, 16 * lm.BATCH + 7):
        found = lm.steps(n)
        assert [i for s in found for i in range(s.start, s.stop)] == list(range(n))
        sizes = [s.stop - s.start for s in found]
        assert n < lm.BATCH or min(sizes) >= 2 / 3 * lm.BATCH and max(sizes) <= 1.5 * lm.BATCH


def test_texts_coded_once_score_as_texts(spark, monkeypatch):
    """Coded texts hold every token's id; fit and score read them in place of the texts. Words end where str.split ends them."""
    texts = [" ".join(f"w{i * k % 1400}" for i in range(k, 800)) for k in range(1, 9)]
    odd = "\x1ca b c\x85​d　a\n\n\ta "
    docs = spark.createDataFrame([*enumerate(texts), (20, odd), (20, odd), (21, None), (22, ""), (None, "w1")], "doc_id long, text string")
    counts = lm.counted(docs)
    plain = Counter(w for r in docs.collect() for w in (r.text or "").split())
    assert {r.word: r.n for r in counts.collect()} == plain
    monkeypatch.setattr(lm, "SHARED", 100)
    coded = lm.coded(docs, counts)
    rows = coded.rows.collect()
    assert len(rows) == docs.count() == len({r.row for r in rows})
    by_id = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert np.frombuffer(r.ids, lm._width(coded.words)).tolist() == coded.words.ids(by_id[r.doc_id]).tolist()
        assert r.n_tokens == len((by_id[r.doc_id] or "").split())
    words, network = lm.fit(coded, rounds=1, counts=counts)
    key = lambda r: (r.doc_id is None, r.doc_id, r.n_tokens)
    once = sorted(lm.score(coded, words, network, counts).collect(), key=key)
    again = sorted(lm.score(docs, words, network, counts).collect(), key=key)
    assert [key(r) for r in once] == [key(r) for r in again]
    assert np.allclose([r.log_prob for r in once], [r.log_prob for r in again])
