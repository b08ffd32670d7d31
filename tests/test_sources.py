import bz2
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from retrograph.operators import lexicon, tags, vectors
from retrograph.plans.queries import inline_lexicon
from retrograph.sources import readers, writers


def lines(path):
    return [x for p in sorted(path.glob("part-*")) for x in p.read_text().splitlines()]


def test_corpus_files(spark, tmp_path):
    (tmp_path / "nested").mkdir()
    (tmp_path / "one.txt").write_text("uno\n\n")
    (tmp_path / "nested" / "two.txt").write_text("dos\n")
    (tmp_path / "b.jsonl").write_text('{"text": "tres"}\n\n{"text": ""}\n{"other": 1}\n')
    for k, want in enumerate((["tres"], ["tres", "uno"], ["tres", "uno", ""], ["tres", "uno", "", "dos"], ["tres", "uno", "", "dos"]), 1):
        assert [r["text"] for r in readers.read_corpus(spark, str(tmp_path), limit_docs=k).collect()] == want
    got = [(r["file"].rsplit("/", 1)[1], r["line"], r["value"]) for r in readers.numbered_lines(spark, str(tmp_path)).collect()]
    assert sorted(got) == [("b.jsonl", 1, '{"text": "tres"}'), ("b.jsonl", 2, ""), ("b.jsonl", 3, '{"text": ""}'), ("b.jsonl", 4, '{"other": 1}'), ("one.txt", 1, "uno"), ("one.txt", 2, ""), ("two.txt", 1, "dos")]
    assert sorted(r["text"] for r in readers.read_corpus(spark, str(tmp_path)).collect()) == ["", "dos", "tres", "uno"]
    assert [r["text"] for r in readers.read_corpus(spark, str(tmp_path / "one.txt")).collect()] == ["uno", ""]
    with pytest.raises(FileNotFoundError):
        readers.read_corpus(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError):
        readers.read_corpus(spark, str(tmp_path), fmt="pdf")
    (tmp_path / "bad.jsonl").write_text("{no\n")
    with pytest.raises(Exception, match="(?i)malformed|corrupt"):
        readers.read_corpus(spark, str(tmp_path / "bad.jsonl")).collect()
    (tmp_path / "bad.jsonl").write_text('{"text": "a"}\n\n[1]\n{"text": "b"}\n{no\n')
    assert [(r["line"], r["value"]) for r in readers.invalid_json_lines(spark, str(tmp_path / "bad.jsonl")).orderBy("line").collect()] == [(3, "[1]"), (5, "{no")]


def test_line_numbers_of_files_that_are_split(spark, tmp_path):
    (tmp_path / "long.txt").write_text("".join(f"line {k}\n" for k in range(1, 3001)))
    (tmp_path / "short.txt").write_text("line 1\nline 2\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 5000)
    try:
        rows = readers.numbered_lines(spark, str(tmp_path))
        assert rows.select(F.spark_partition_id()).distinct().count() > 2
        assert rows.where(F.concat(F.lit("line "), "line") != F.col("value")).count() == 0
        assert [r["text"] for r in readers.read_corpus(spark, str(tmp_path), limit_docs=1500).collect()] == [f"line {k}" for k in range(1, 1501)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_pair_files(spark, tmp_path):
    (tmp_path / "p.tsv").write_text('source_text\ttarget_text\tpair_score\tsource_count\tsource_n\nro"da\ta dor\t4.2\t5.0\t\ncasa\t\tx\t\t1\n')
    got = readers.read_pairs(spark, str(tmp_path / "p.tsv")).orderBy("id").collect()
    assert [(r["source_text"], r["target_text"], r["pair_score"], r["source_count"], r["source_n"], r["target_lang"]) for r in got] == [('ro"da', "a dor", 4.2, 5, 0, ""), ("casa", "", 0.0, 0, 1, "")]
    (tmp_path / "f.tsv").write_text("source_phrase\ttarget_phrase\tphrase_score\nse le\teles\t7.5\n")
    r = readers.read_pairs(spark, str(tmp_path / "f.tsv")).first()
    assert (r["source_text"], r["target_text"], r["pair_score"]) == ("se le", "eles", 7.5)


def test_tsv_round_trip_and_refusal(spark, tmp_path):
    rows = spark.createDataFrame([("a b", 1, ["x", "y"])], "source_text string, source_count bigint, l array<string>")
    writers.write_tsv(rows, str(tmp_path / "o"), single=True)
    assert lines(tmp_path / "o") == ["source_text\tsource_count\tl", 'a b\t1\t["x","y"]']
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_tsv(rows, str(tmp_path / "o"))
    writers.write_tsv(rows, str(tmp_path / "o"), force=True)


def test_json_and_text_sinks(spark, tmp_path):
    d = spark.createDataFrame([("roda", 2, "a dor"), ("roda", 2, "a bor"), ("roda", 1, "ador"), ("b", 1, "b")], "source string, word_count int, phrase string")
    writers.write_decompositions(d, str(tmp_path / "d"))
    assert [json.loads(x) for x in lines(tmp_path / "d")] == [{"b": {"1": ["b"]}}, {"roda": {"1": ["ador"], "2": ["a bor", "a dor"]}}]
    (tmp_path / "s.json").write_text(json.dumps({"roda": {"2": ["a dor"]}}))
    assert [tuple(r) for r in readers.read_decompositions(spark, str(tmp_path / "s.json")).collect()] == [("roda", 2, "a dor")]
    writers.write_lexicon(spark.createDataFrame([("b", "y"), ("b", "x"), ("a", "z")], "word string, pos string"), str(tmp_path / "l"))
    assert lines(tmp_path / "l") == ['{"a":["z"]}', '{"b":["x","y"]}']
    corpus = spark.createDataFrame([(1, "T", " text "), (2, None, "more"), (3, "x", " ")], "id int, title string, text string")
    writers.write_corpus_jsonl(corpus, str(tmp_path / "c"))
    assert json.loads(lines(tmp_path / "c")[0]) == {"id": 1, "url": None, "title": "T", "text": " text "}
    writers.write_corpus_text(corpus.coalesce(1), str(tmp_path / "t"))
    assert lines(tmp_path / "t") == ["", "", "# T", "", "text", "more"]
    writers.write_visible_pairs(spark.createDataFrame([("a", "b")], "source_text string, target_text string"), str(tmp_path / "v"))
    assert lines(tmp_path / "v") == ["a ↔ b"]
    assert writers.write_embeddings(spark.createDataFrame([("w", [1.0])], "word string, embedding array<float>"), str(tmp_path / "e"))
    assert not writers.write_embeddings(spark.createDataFrame([("w", [2.0])], "word string, embedding array<float>"), str(tmp_path / "e"))
    assert readers.read_embeddings(spark, str(tmp_path / "e")).first()["embedding"] == [1.0]


def test_lexicon_files(spark, tmp_path):
    (tmp_path / "w.txt").write_text(" a \n\n b c\n")
    assert [r[0] for r in readers.read_lexicon(spark, str(tmp_path / "w.txt")).collect()] == ["a", "b c"]
    assert readers.read_filter_words(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "l.json").write_text(json.dumps({"casa": [{"source": "s", "lemma": "casa", "pos": "NOUN", "tag": "NC"}], "x": []}))
    assert {(r["form"], r["tag"]) for r in readers.read_json_lexicon(spark, str(tmp_path / "l.json")).collect()} == {("casa", "NC"), ("x", None)}
    np.savez(tmp_path / "v.npz", words=np.array(["a", "b"]), embeddings=np.eye(2, dtype=np.float32))
    assert [r["embedding"] for r in readers.read_embeddings(spark, str(tmp_path / "v.npz")).collect()] == [[1.0, 0.0], [0.0, 1.0]]
    (tmp_path / "dicc.src").write_text("casa casa NCFS000 casar VMIP3S0\nodd lemma\n\nsolo\n")
    rows = readers.read_dictionary(spark, str(tmp_path / "dicc.src"))
    found = lexicon.analyses(lexicon.dictionary_entries(rows)).collect()
    assert [(r["form"], [(a["lemma"], a["pos"]) for a in r["analyses"]]) for r in found] == [("casa", [("casa", "NOUN"), ("casar", "VERB")])]
    assert [r["value"] for r in lexicon.malformed_lines(rows).collect()] == ["odd lemma"]


def test_wiki_dump(spark, tmp_path):
    pages = "".join(f"<page><title>{t}</title><ns>{n}</ns><revision><id>1</id><text xml:space='preserve'>{x}</text></revision></page>" for t, n, x in [("Casa", 0, "== {{lengua|es}} ==\n=== {{sustantivo|es}} ===\n"), ("Modelo:conx.gl.ar", 10, "{{gl|{{{1}}}o}}"), ("cantar", 0, "{{-gl-}}{{son|||gl}}{{-verbo-|gl}}{{conx.gl.ar|cant}}"), ("Vacío", 0, "")])
    (tmp_path / "d.xml.bz2").write_bytes(bz2.compress(f"<mediawiki>{pages}</mediawiki>".encode()))
    dump = readers.read_wiki_dump(spark, str(tmp_path / "d.xml.bz2"))
    assert dump.count() == 4
    assert [tuple(r) for r in lexicon.spanish_lexicon(dump).collect()] == [("casa", "sustantivo")]
    assert {tuple(r) for r in lexicon.galician_lexicon(dump).collect()} == {("cantar", "verbo"), ("canto", "forma_verbal")}
    assert [r["pos"] for r in lexicon.collected(lexicon.galician_lexicon(dump)).collect()] == [["verbo"], ["forma_verbal"]]


def test_tag_candidates_and_rules(spark):
    lex = inline_lexicon(spark)
    index = tags.tag_index(lex)
    got = {r["candidate"] for r in tags.candidates(index, ["DAXXSX", "NCXXXXX"], "es").collect()}
    assert got == {"el perro", "la casa", "el ex-novio", "el sr.", "el crisis", "la crisis"} - {"el crisis"}
    assert tags.candidates(index, None, "es").count() == index.count()
    assert tags.candidates(index, ["QQ"], "es").count() == 0
    valid, refused = tags.apply_form_rules(lex)
    assert {(r["form"], r["reason"]) for r in refused.collect()} == {("ex-novio", "hyphenated"), ("sr.", "dotted"), ("a€", "unicode_symbol"), ("x-y.z€", "hyphenated"), ("x-y.z€", "dotted"), ("x-y.z€", "unicode_symbol"), ("ex-novio", "unicode_symbol"), ("sr.", "unicode_symbol")}
    assert valid.count() == lex.select("form").distinct().count() - 4
    one = lex.where("form = 'la'").select(tags.features(F.col("tag"), "es")).first()[0]
    assert one == {"pos": "D", "type": "A", "gender": "F", "number": "S"}


def test_cosine(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0])], "vec_id bigint, embedding array<float>")
    q = spark.createDataFrame([(9, [3.0, 0.0])], "query_id bigint, embedding array<float>")
    assert [(r["vec_id"], r["similarity"], r["rank"]) for r in vectors.top_k(q, v, 2).orderBy("rank").collect()] == [(1, 1.0, 1), (3, 0.707107, 2)]


def test_cosine_against_a_slow_version(spark, monkeypatch):
    rng = np.random.default_rng(3)
    held = [(k, rng.integers(-3, 4, 5).astype(float).tolist()) for k in range(300)]
    held += [(300, None), (301, [1.0, 2.0]), (302, [0.0] * 5), (303, [1.0, None, 1.0, 1.0, 1.0]), (None, [1.0] * 5), (304, [])]
    frame = spark.createDataFrame(held, "vec_id bigint, embedding array<float>").repartition(5)
    asked = [(k, e) for k, e in held if k is not None and k % 7 == 0]
    queries = spark.createDataFrame(asked, "query_id bigint, embedding array<float>")
    want = []
    for q, e in asked:
        if e is None or None in e or not any(e):
            continue
        near = [(-round(float(np.dot(e, x) / np.linalg.norm(e) / np.linalg.norm(x)), 9), k) for k, x in held if k is not None and x and len(x) == len(e) and None not in x and any(x)]
        want += [(q, k, rank, round(-s, 6)) for rank, (s, k) in enumerate(sorted(near)[:4], 1)]
    for block in (vectors.QUERY_BLOCK, 10):
        monkeypatch.setattr(vectors, "QUERY_BLOCK", block)
        got = sorted((r["query_id"], r["vec_id"], r["rank"], r["similarity"]) for r in vectors.top_k(queries, frame, 4).collect())
        assert got == sorted(want)
    assert vectors.top_k(queries.limit(0), frame, 4).collect() == []
    assert vectors.top_k(queries, frame.limit(0), 4).collect() == []


def test_encoders_are_loaded_in_tasks(spark):
    def load():
        return lambda texts: np.array([[len(t), t.count("a")] for t in texts])

    words = spark.createDataFrame([("casa",), ("casa",), ("b",), (" ",), (None,)], "word string")
    got = vectors.encode(words, load, batch=1, prefix="query: ").collect()
    assert {(r["word"], tuple(r["embedding"])) for r in got} == {("casa", (11.0, 2.0)), ("b", (8.0, 0.0))}
