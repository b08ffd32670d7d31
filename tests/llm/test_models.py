import random

import numpy as np
import pyarrow as pa
import pytest

from retrograph.llm import bytescan, common, lm_scoring, quality_classifier, quality_rules, toxicity

from .data import awkward, frame, words


def labelled(seed=2, n=300):
    """Good texts of one kind of words, bad ones that repeat and shout; toxic ones hold a few telling words."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        good, toxic = rnd.random() < 0.6, rnd.random() < 0.2
        text = words(rnd, rnd.randint(20, 80), "aeilmnrst") + "." if good else " ".join([rnd.choice(["BUY", "NOW!!!", "###"])] * 3 + [words(rnd, 6, "xyzqw")] * 4)
        if toxic:
            text += " " + " ".join(rnd.choice(["gromfen", "vexil", "drathul"]) for _ in range(rnd.randint(1, 7)))
        rows.append((k, text))
        labels.append((k, int(good), int(toxic), "extra"))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, text string")


def test_words_against_regular_expressions():
    import re

    texts = [t or "" for _, t in awkward()] + ["", "é1 a-b"]
    for lo, hi, raw, at in bytescan.chunks(pa.array(texts), 500):
        w = bytescan.Words(raw, at)
        for k in range(hi - lo):
            own = [raw[s:e].tobytes() for s, e in zip(w.start[w.offset[k] : w.offset[k + 1]], w.end[w.offset[k] : w.offset[k + 1]], strict=True)]
            assert own == re.findall(rb"[0-9A-Za-z\x80-\xff]+", texts[lo + k].encode())


def test_quality_on_unseen_documents(spark):
    rows, labels = labelled()
    docs = frame(spark, rows)
    model = quality_classifier.fit_quality(docs, label_frame(spark, labels[:200]))
    got = {r["doc_id"]: r["keep"] for r in quality_classifier.score_quality(docs, model).collect()}
    assert np.mean([got[k] == bool(q) for k, q, *_ in labels[200:]]) > 0.95
    kept = quality_classifier.filter_quality(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, v in got.items() if v}


def test_quality_scores_equal_a_slow_version():
    rows, labels = labelled(5, 60)
    text = pa.array([t for _, t in rows])
    model = quality_classifier.train(text, np.array([q for _, q, *_ in labels]))
    fast = model.probability(text)
    for k in range(0, 60, 7):
        total, n = 0.0, 0
        raw, at = bytescan.text_bytes(text.slice(k, 1))
        for idx, _ in quality_classifier._families(raw, at):
            total += model.table[idx].astype(float).sum()
            n += len(idx)
        assert fast[k] == pytest.approx(1 / (1 + np.exp(-(total / n + model.bias))), rel=1e-6)


@pytest.mark.parametrize("which", ["quality", "rules", "toxicity"])
def test_awkward_documents(spark, which):
    rows = awkward()
    docs = frame(spark, rows)
    good = label_frame(spark, [(k, k % 2, int(k % 3 == 0), "x") for k in range(40)] + [(0, 1, 1, "again"), (None, 1, 0, None), (7, None, None, None)])
    fit, score, keep = {
        "quality": (quality_classifier.fit_quality, quality_classifier.score_quality, quality_classifier.filter_quality),
        "rules": (quality_rules.fit_rules, quality_rules.score_rules, quality_rules.filter_rules),
        "toxicity": (toxicity.fit_severity, toxicity.score_severity, None),
    }[which]
    for labels in (good, good.limit(0)):
        model = fit(docs, labels)
        got = score(docs, model).collect()
        assert len(got) == len(rows)
        assert all(r[1] is not None and r[2] is not None for r in got)
        assert len({tuple(r) for r in got if r["doc_id"] == 0}) == 1
        if keep:
            assert keep(docs, model).count() == sum(r["keep"] for r in got)
        assert score(docs.limit(0), model).collect() == []
    assert len(score(docs, fit(docs.limit(0), good)).collect()) == len(rows)


def test_without_labels_all_stay(spark):
    docs, none = frame(spark, awkward()), label_frame(spark, []).limit(0)
    assert all(r["keep"] for r in quality_classifier.score_quality(docs, quality_classifier.fit_quality(docs, none)).collect())
    assert all(r["keep"] and r["log_ratio"] == 0 for r in quality_rules.score_rules(docs, quality_rules.fit_rules(docs, none)).collect())
    assert not any(r["toxic"] for r in toxicity.score_severity(docs, toxicity.fit_severity(docs, none)).collect())


def test_rules_against_a_slow_version(spark):
    rows, labels = labelled(7, 120)
    rows += [(500, None), (501, ""), (0, rows[0][1])]
    trusted = {k for k, q, *_ in labels if q}
    counts = np.zeros((2, quality_rules.BUCKETS))
    own = []
    for i, t in rows:
        raw, at = bytescan.text_bytes(pa.array([t], pa.string()))
        grams = np.concatenate([b for b, _ in quality_rules.token_grams(raw, at)])
        own.append(grams)
        for b in grams:
            counts[0, b] += 1
            counts[1, b] += i in trusted
    share = (counts[0] + 0.5) / (counts[0].sum() + 0.5 * quality_rules.BUCKETS)
    ratio = np.log((counts[1] + quality_rules.PRIOR * share) / (counts[1].sum() + quality_rules.PRIOR) / share)
    want = sorted((i, round(float(ratio[g].mean()) if len(g) else 0.0, 5)) for (i, _), g in zip(rows, own, strict=True))
    docs = frame(spark, rows)
    got = quality_rules.score_rules(docs, quality_rules.fit_rules(docs, label_frame(spark, labels))).collect()
    have = sorted((r["doc_id"], r["log_ratio"]) for r in got)
    assert [i for i, _ in have] == [i for i, _ in want]
    assert [x for _, x in have] == pytest.approx([x for _, x in want], abs=2e-5)
    assert all(r["keep"] == (r["log_ratio"] >= quality_rules.THRESHOLD) for r in got)


def test_severity_on_unseen_documents(spark):
    rows, labels = labelled(11, 400)
    docs = frame(spark, rows)
    model = toxicity.fit_severity(docs, label_frame(spark, labels[:250]))
    got = {r["doc_id"]: r for r in toxicity.score_severity(docs, model).collect()}
    assert np.mean([got[k]["toxic"] == bool(t) for k, _, t, _ in labels[250:]]) > 0.97
    assert (np.diff(model.limits) >= 0).all() and (model.weights >= 0).all()
    marks = lambda t: sum(t.split().count(w) > 0 for w in ("gromfen", "vexil", "drathul"))
    by = [np.mean([got[k]["severity"] for k, t in rows if marks(t) == m]) for m in range(4)]
    assert by[0] < by[1] <= by[2] <= by[3] <= 3


def test_ordinal_gradients_against_differences():
    rng = np.random.default_rng(4)
    z, limits, grade, weight = rng.normal(size=50) * 2, np.array([-0.5, 0.4, 1.5]), rng.integers(0, 4, 50), rng.random(50)
    p = np.concatenate((np.ones((50, 1)), 1 / (1 + np.exp(limits - z[:, None])), np.zeros((50, 1))), axis=1)
    loss, by_score, by_limit = toxicity.ordinal_loss(z, limits, grade, weight)
    assert loss == pytest.approx(-sum(w * np.log(p[k, g] - p[k, g + 1]) for k, (g, w) in enumerate(zip(grade, weight, strict=True))))
    for got, at in ((by_score, z), (by_limit, limits)):
        for k in range(len(at)):
            sides = []
            for d in (1e-5, -1e-5):
                own = at.copy()
                own[k] += d
                sides.append(toxicity.ordinal_loss(own if at is z else z, own if at is limits else limits, grade, weight)[0])
            assert got[k] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-6)


def test_sample_of_repeated_and_missing_documents(spark):
    docs = frame(spark, [(1, "b"), (1, "a"), (1, None), (2, "c"), (3, None), (None, "d")])
    labels = label_frame(spark, [(k, 1, 0, "") for k in range(100, 160)] + [(1, 1, 0, ""), (1, 0, 0, ""), (2, 1, 0, ""), (3, 0, 0, ""), (None, 1, 0, "")])
    text, y = common.labelled_sample(docs, labels, "quality", 4)
    assert list(zip(text.to_pylist(), y.tolist(), strict=True)) == [("a", 0), ("c", 1), (None, 0)]


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError):
        common.shared_dir(Session)


def slow_expected(texts, weights):
    """Counts and expected counts of classes, a word at a time."""
    counts, expected = np.zeros(weights.shape), np.zeros(weights.shape)
    for _, _, raw, at in bytescan.chunks(pa.array(texts)):
        events = lm_scoring.Events(bytescan.Words(raw, at))
        rows = [*events.rows(), np.full(len(events.cls), lm_scoring._ROWS)]
        for k, y in enumerate(events.cls):
            z = sum(weights[r[k]].astype(float) for r in rows)
            p = np.exp(z - z.max())
            p /= p.sum()
            for r in rows:
                counts[r[k], y] += 1
                expected[r[k]] += p
    return counts, expected


def test_expected_counts_equal_a_slow_version(spark):
    texts = [t[:3000] for _, t in awkward(6) if t] + ["a a a b a a"] * 3
    rng = np.random.default_rng(3)
    weights = rng.normal(size=(lm_scoring._ROWS + 1, lm_scoring.CLASSES)).astype(np.float32)
    counts, expected = slow_expected(texts, weights)
    docs = frame(spark, list(enumerate(texts)))
    got, words = lm_scoring._gather(docs, None)
    assert np.array_equal(got, counts)
    assert np.abs(lm_scoring._gather(docs, weights)[0] - expected).max() < 1e-2
    seen: dict = {}
    for _, _, raw, at in bytescan.chunks(pa.array(texts)):
        for h in lm_scoring.Events(bytescan.Words(raw, at)).hash.tolist():
            seen[h >> 41] = seen.get(h >> 41, 0) + 1
    assert {int(k): int(words[k]) for k in np.flatnonzero(words[:-1])} == seen
    assert words[-1] == sum(bool(lm_scoring.bytescan.count_words(*bytescan.text_bytes(pa.array([t])))[0]) for t in texts)


def slow_words(group, before, word, counted, share, rounds):
    """P(word | class, context) by dictionaries, with every sum over all words of a class written out."""
    per = len(share) // lm_scoring.CLASSES
    q = np.exp(share.astype(float))
    cls = lambda w: range(w // per * per, w // per * per + per)
    pair, triple = {}, {}
    for g, b, w, c in zip(group, before, word, counted, strict=True):
        pair[g, w] = pair.get((g, w), 0) + c
        triple[g, b, w] = triple.get((g, b, w), 0) + c
    weight, fine = ({k: 0.0 for k, n in d.items() if n >= 2} for d in (pair, triple))

    def share_of(g, b, w):
        up = lambda v: q[v] * np.exp(weight.get((g, v), 0) + (fine.get((g, b, v), 0) if b is not None else 0))
        return up(w) / sum(up(v) for v in cls(w))

    def begin(seen, whole, pull, prior, keys):
        p = [(n - 1 + pull * x) / (whole + pull) for n, x in zip(seen, prior, strict=True)]
        return {k: np.log(a / x * max(1 - sum(prior), 1e-6) / max(1 - sum(p), 1e-6)) for k, a, x in zip(keys, p, prior, strict=True)}

    for g, c in {(g, w // per) for g, w in pair}:
        keys = [k for k in weight if k[0] == g and k[1] // per == c]
        whole = sum(n for k, n in pair.items() if k[0] == g and k[1] // per == c)
        weight |= begin([pair[k] for k in keys], whole, lm_scoring.PULL[0], [q[k[1]] for k in keys], keys)
    start = {}
    for g, b, c in {(g, b, w // per) for g, b, w in triple}:
        keys = [k for k in fine if k[:2] == (g, b) and k[2] // per == c]
        whole = sum(n for k, n in triple.items() if k[:2] == (g, b) and k[2] // per == c)
        start |= begin([triple[k] for k in keys], whole, lm_scoring.PULL[1], [share_of(g, None, k[2]) for k in keys], keys)
    fine |= start
    for _ in range(rounds):
        expected, fine_expected = dict.fromkeys(weight, 0.0), dict.fromkeys(fine, 0.0)
        for g, b, w, c in zip(group, before, word, counted, strict=True):
            for v in cls(w):
                if (g, v) in weight:
                    expected[g, v] += c * share_of(g, b, v)
                if (g, b, v) in fine:
                    fine_expected[g, b, v] += c * share_of(g, b, v)
        for d, e, n, pull in ((weight, expected, pair, lm_scoring.PULL[0]), (fine, fine_expected, triple, lm_scoring.PULL[1])):
            for k in d:
                d[k] += lm_scoring.RATE * (n[k] - 1 - e[k]) / (max(n[k] - 1, e[k]) + pull)
    assert all(abs(sum(share_of(g, b, v) for v in cls(w)) - 1) < 1e-9 for g, b, w in triple)
    return [np.log(share_of(g, b, w)) for g, b, w in zip(group, before, word, strict=True)]


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_words_of_a_class_against_a_slow_version(rounds):
    rng = np.random.default_rng(rounds)
    n = 300
    share = lm_scoring.word_shares(rng.poisson(2, 512))
    assert np.allclose(np.exp(share.astype(float)).reshape(lm_scoring.CLASSES, -1).sum(1), 1, atol=1e-5)
    group, before, word = rng.integers(0, 5, n), rng.integers(0, 3, n), np.minimum(rng.geometric(0.05, n), 60)
    counted = (rng.random(n) < 0.8).astype(np.int32)
    got = lm_scoring.word_log_probabilities(group, before, word, counted, share, rounds)
    assert got == pytest.approx(slow_words(group.tolist(), before.tolist(), word.tolist(), counted.tolist(), share, rounds), abs=1e-5)
    assert len(lm_scoring.word_log_probabilities(*(np.zeros(0, int),) * 4, share)) == 0


def chains(n, seed=9):
    rnd = random.Random(seed)
    follow = {w: rnd.sample("abcdefghijklmnopqrstuvwxyz", 2) for w in "abcdefghijklmnopqrstuvwxyz"}
    rows = []
    for k in range(n):
        w, text = rnd.choice("abc"), []
        for _ in range(60):
            text.append(w)
            w = rnd.choice(follow[w])
        rows.append((k, " ".join(text)))
    return rows, rnd


@pytest.mark.parametrize("parts", [1, 7])
def test_scores_of_documents_against_a_slow_version(spark, monkeypatch, parts):
    rows = [(i, t[:4000] if t else t) for i, t in awkward(5)] + chains(20)[0]
    docs = frame(spark, rows).repartition(parts)
    monkeypatch.setattr(lm_scoring, "PART_WORDS", 500)
    model = lm_scoring.fit_lm(docs)
    got = sorted(str((r["doc_id"], r["n_words"])) + f"{r['log_prob']:.2f}" for r in lm_scoring.score_lm(docs, model).collect())
    last, before, word, cls, doc = [], [], [], [], []
    for k, (_, t) in enumerate(rows):
        for _, _, raw, at in bytescan.chunks(pa.array([t], pa.string())):
            e = lm_scoring.Events(bytescan.Words(raw, at))
            for into, h in ((last, e.last), (before, e.before), (word, e.hash)):
                into += lm_scoring.Events.words(h, model.bits).tolist()
            cls += lm_scoring.class_log_probabilities(e, model.weights).tolist()
            doc += [k] * len(e.hash)
    _, group = np.unique(last, return_inverse=True)
    score = cls + lm_scoring.word_log_probabilities(group, np.array(before), np.array(word), np.ones(len(word), np.int32), model.share)
    total, count = np.bincount(doc, score, len(rows)), np.bincount(doc, minlength=len(rows))
    want = sorted(str((i, int(n))) + f"{x:.2f}" for (i, _), n, x in zip(rows, count, total, strict=True))
    near = [(a.rsplit(")", 1), b.rsplit(")", 1)) for a, b in zip(got, want, strict=True)]
    assert all(a[0] == b[0] and abs(float(a[1]) - float(b[1])) < 0.05 for a, b in near)


def test_language_model_learns(spark):
    rows, rnd = chains(150)
    docs = frame(spark, rows)
    before, model = lm_scoring.fit_lm(docs, 0), lm_scoring.fit_lm(docs)
    raw, at = bytescan.text_bytes(pa.array([t for _, t in rows]))
    events = lm_scoring.Events(bytescan.Words(raw, at))
    assert lm_scoring.class_log_probabilities(events, model.weights).sum() > lm_scoring.class_log_probabilities(events, before.weights).sum()
    unseen = chains(190)[0][150:]
    shuffled = [(k, " ".join(rnd.sample(t.split(), 60))) for k, t in unseen]
    real, mixed = (sum(r["log_prob"] for r in lm_scoring.score_lm(frame(spark, x), model, docs).collect()) for x in (unseen, shuffled))
    assert mixed < real - 1000
    for split in (model.split, 40):  # hot last words are split
        own = lm_scoring.fit_lm(docs, split=split)
        got = lm_scoring.score_lm(frame(spark, awkward()), own, docs).collect()
        assert len(got) == len(awkward()) and sorted(r["doc_id"] or -1 for r in got) == sorted(i or -1 for i, _ in awkward())
        for r in got:
            assert (r["mean_log_prob"] is None) == (r["n_words"] == 0)
            assert r["log_prob"] <= 0
        assert len({r["log_prob"] for r in got if r["doc_id"] == 0}) == 1
        assert len(own.hot) == 0 if split == model.split else len(own.hot) > 20
    assert lm_scoring.score_lm(docs.limit(0), model).collect() == []
    empty = lm_scoring.fit_lm(docs.limit(0), 1)
    assert empty.total == 0 and len(lm_scoring.score_lm(frame(spark, awkward()), empty).collect()) == len(awkward())


def test_scores_do_not_depend_on_how_events_are_shared_out(spark, monkeypatch):
    """The same scores whether last words are hot, parts are many, or events don't fit a task."""
    docs = frame(spark, chains(60)[0] + [(100, "a " * 700), (101, "b a " * 300), (102, "a"), (103, None), (None, "a b c")])
    found = []
    for split, words_, events in ((lm_scoring.SPLIT, 10**6, 10**6), (40, 10**6, 10**6), (40, 500, 10**6), (lm_scoring.SPLIT, 10**6, 300), (40, 500, 100)):
        monkeypatch.setattr(lm_scoring, "PART_WORDS", words_)
        monkeypatch.setattr(lm_scoring, "PART_EVENTS", events, raising=False)
        for corpus in (None, docs):
            rows = lm_scoring.score_lm(docs, lm_scoring.fit_lm(docs, split=split), corpus).collect()
            found.append((corpus is None, sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["log_prob"]) for r in rows)))
    for alone, rows in found[2:]:
        want = next(x for same, x in found if same == alone)
        assert [r[:2] for r in rows] == [r[:2] for r in want]
        assert [r[2] for r in rows] == pytest.approx([r[2] for r in want], abs=2e-4)


@pytest.mark.parametrize("limit", [50, 70])
def test_slices_of_contexts_against_a_slow_version(limit):
    rng = np.random.default_rng(limit)
    n = 300
    share = lm_scoring.word_shares(rng.poisson(2, 512))
    last, before, word = rng.integers(0, 5, n), rng.integers(0, 3, n), np.minimum(rng.geometric(0.05, n), 60)
    blocks, doc = rng.integers(0, 4, n), np.arange(n)  # events of block 1 are only scored
    blobs = []
    for b in range(4):
        at = np.flatnonzero(blocks == b)
        at = at[np.argsort(last[at], kind="stable")]
        own, size = np.unique(last[at], return_counts=True)
        head = [np.array([len(own), len(at)], "<i8"), own.astype("<u4"), size.astype("<u4")]
        blobs.append(b"".join(x.tobytes() for x in head) + lm_scoring._three(before[at]) + lm_scoring._three(word[at]) + doc[at].astype("<u2").tobytes())
    names = [2, 3, 6, 10]
    batch = pa.RecordBatch.from_arrays([pa.array([0] * 4, pa.int32()), pa.array(names, pa.int64()), pa.array(blobs, pa.binary())], ["part", "block", "blob"])
    got = np.zeros(n)
    for rows in lm_scoring._score_part(iter([batch]), share, limit):
        for name, blob in zip(rows["block"].to_pylist(), rows["blob"].to_pylist(), strict=True):
            there, score = np.frombuffer(blob, "<u2", len(blob) // 10), np.frombuffer(blob, "<f8", len(blob) // 10, len(blob) // 5)
            assert all(names[blocks[k]] == name for k in there)
            got[there] += score
    want = slow_words(last.tolist(), before.tolist(), word.tolist(), (blocks != 1).astype(int).tolist(), share, lm_scoring.WORD_ROUNDS)
    assert got == pytest.approx(want, abs=1e-5)


def test_sample_does_not_depend_on_partitions(spark):
    rows, labels = labelled(1, 80)
    a, b = (common.labelled_sample(frame(spark, rows).repartition(n), label_frame(spark, labels), "quality", 30) for n in (1, 7))
    assert a[0].equals(b[0]) and (a[1] == b[1]).all() and len(a[1]) <= 30
