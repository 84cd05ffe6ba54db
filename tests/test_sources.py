import pytest
from pyspark.sql import functions as F

from sentloom.operators.numbering import number_lines, number_rows
from sentloom.sources import corpus, sinks, staging


@pytest.fixture
def small_splits(spark):
    """Cut even small files into many blocks."""
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "100"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_line_numbers_follow_the_files_over_many_blocks(spark, tmp_path, small_splits):
    texts = {"a.txt": [f"a {i} é" for i in range(1500)], "b.txt": ["", "x\ty", *[f"b {i}" * 3 for i in range(700)]], "c.txt": []}
    for name, lines in texts.items():
        (tmp_path / name).write_text("".join(line + "\n" for line in lines), encoding="utf8")
    df = corpus.read_lines(spark, f"{tmp_path}/*.txt")
    assert spark.read.text(f"{tmp_path}/*.txt").rdd.getNumPartitions() > 4
    want = [t for lines in texts.values() for t in lines]
    got = sorted((r.line_no, r.text) for r in df.collect())
    assert got == [(i + 1, t) for i, t in enumerate(want)]


def test_read_parallel_pads(spark, tmp_path):
    (tmp_path / "c.en").write_text("one\ntwo\nthree\n")
    (tmp_path / "c.de").write_text("eins\nzwei")
    df = corpus.read_parallel(spark, f"{tmp_path}/c.en", f"{tmp_path}/c.de", "c", "en", "de")
    assert sorted((r.line_no, r.src, r.tgt) for r in df.collect()) == [(1, "one", "eins"), (2, "two", "zwei"), (3, "three", "")]


def test_read_scored_takes_fields_as_they_are(spark, tmp_path):
    (tmp_path / "s.tsv").write_text('a "b\tc\\\t0.5\nx\ty\tabc\nx\ty\tnan\nx\ty\t1e0\nx\ty\n')
    rows = [tuple(r) for r in corpus.read_scored(spark, str(tmp_path / "s.tsv")).collect()]
    assert rows[0] == ('a "b', "c\\", 0.5)
    assert rows[1][2] is None and rows[2][2] != rows[2][2] and rows[3][2] == 1.0 and rows[4][2] is None


def test_written_sides_stay_aligned(spark, tmp_path):
    rows = [(i, f"s{i}" if i % 7 else "a\nb\tc", f"t{i}") for i in range(2000, 0, -1)]
    df = spark.createDataFrame(rows, "line_no bigint, src string, tgt string").repartition(7)
    src, tgt = sinks.write_sides(df, str(tmp_path / "out"))
    back = corpus.read_parallel(spark, src, tgt, "c", "l1", "l2").orderBy("line_no").collect()
    want = [("a b c" if i % 7 == 0 else f"s{i}", f"t{i}") for i in range(1, 2001)]
    assert [(r.src, r.tgt) for r in back] == want


def test_wordfreq_file_is_ordered_and_gzipped(spark, tmp_path):
    counts = spark.createDataFrame([("a", 2), ("b", 10), ("c", 10), ("é", 2)], "word string, count bigint")
    path = sinks.write_wordfreq(counts, str(tmp_path / "wf"))
    assert list((tmp_path / "wf").glob("*.gz"))
    assert [r.value for r in spark.read.text(path).collect()] == ["10 c", "10 b", "2 é", "2 a"]


def test_materialize_once_builds_once_and_replaces_unfinished(spark, tmp_path):
    path, calls = str(tmp_path / "stage"), []

    def build():
        calls.append(1)
        return spark.range(3)

    assert staging.materialize_once(spark, build, path).count() == 3
    assert staging.materialize_once(spark, build, path).count() == 3
    assert len(calls) == 1
    (tmp_path / "stage" / "_SUCCESS").unlink()
    assert staging.materialize_once(spark, build, path).count() == 3
    assert len(calls) == 2


def test_staging_uses_the_sessions_folder(spark):
    assert staging.staging_root(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_numbering_does_not_depend_on_partitions(spark, parts):
    # One group holds most rows.
    rows = [("hot" if i % 10 else f"g{i % 3}", (i * 7919) % 5000) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, v bigint").repartition(parts)
    got = number_rows(df, [F.col("v")], by=["g"]).collect()
    for g in {r.g for r in got}:
        ordered = sorted((r for r in got if r.g == g), key=lambda r: r.v)
        assert [r.line_no for r in ordered] == list(range(1, len(ordered) + 1))
    flat = number_rows(df.select("v"), [F.desc("v")], name="id", start=0).collect()
    assert [r.id for r in sorted(flat, key=lambda r: -r.v)] == list(range(1000))


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_line_numbers_of_documents(spark, parts):
    # Sparse ids, a NULL language, NULL ids, equal ids and copies.
    docs = [(d, ("en", "de", None)[i % 3], "s", "\n".join(f"{d}.{i}.{j}" for j in range(i % 4 + 1))) for i, d in enumerate((9, 0, 4_000_000_000, 5, 70_000, 2, 3, 11, 5, -3))]
    docs += [(None, "en", "s", "n1\nn2"), (None, "en", "s", "n1\nn2"), (None, None, None, "x"), (None, "de", "s", None), (8, "de", "s", "")]
    df = spark.createDataFrame(docs, "doc_id bigint, lang string, source string, text string").repartition(parts)
    got = number_lines(df).collect()
    for lang in ("en", "de", None):
        own = sorted((r for r in got if r.lang == lang), key=lambda r: r.line_no)
        want = sorted((d for d in docs if d[1] == lang), key=lambda d: (d[0] is not None, d[0] or 0))
        assert [r.line_no for r in own] == list(range(1, len(own) + 1))
        assert [r.doc_id for r in own] == [d[0] for d in want for _ in (d[3].split("\n") if d[3] is not None else [None])]
        assert sorted((r.text for r in own), key=str) == sorted((t for d in want for t in (d[3].split("\n") if d[3] is not None else [None])), key=str)
        # A document's lines follow each other in their order.
        for d in want:
            lines = d[3].split("\n") if d[3] is not None else [None]
            starts = [r.line_no for r in own if r.doc_id == d[0] and r.pos == 0 and r.text == lines[0]]
            assert starts and all([r.text for r in own if s <= r.line_no < s + len(lines)] == lines for s in starts)


def test_numbering_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 3), ("a", 1), (None, 2), ("a", 5)], "g string, v bigint")
    got = {(r.g, r.v): r.line_no for r in number_rows(df, [F.col("v")], by=["g"]).collect()}
    assert got == {(None, 2): 1, (None, 3): 2, ("a", 1): 1, ("a", 5): 2}


def test_files_follow_each_other_as_listed(spark, tmp_path):
    for name, lines in {"z.en": ["z1", "z2"], "a.en": ["a1"], "1.de": ["eins", "zwei"], "2.de": ["drei"]}.items():
        (tmp_path / name).write_text("".join(f"{x}\n" for x in lines))
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.files.minPartitionNum", None)
    df = corpus.read_parallel(spark, [f"{tmp_path}/z.en", f"{tmp_path}/a.en"], [f"{tmp_path}/1.de", f"{tmp_path}/2.de"], "c", "en", "de")
    assert sorted((r.line_no, r.src, r.tgt) for r in df.collect()) == [(1, "z1", "eins"), (2, "z2", "zwei"), (3, "a1", "drei")]
    twice = corpus.read_lines(spark, [f"{tmp_path}/a.en", f"{tmp_path}/z.en", f"{tmp_path}/a.en"]).collect()
    assert [r.text for r in sorted(twice, key=lambda r: r.line_no)] == ["a1", "z1", "z2", "a1"]
    # A read leaves the session as it was.
    assert (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.files.minPartitionNum", None)) == before


def test_named_corpora(spark, tmp_path):
    for name in ("news", "web"):
        (tmp_path / f"{name}.en").write_text(f"{name} one\n{name}\ttwo\r\n")
    got = corpus.read_corpora(spark, str(tmp_path), ["web", "news"], "en").orderBy("line_no").collect()
    assert [(r.corpus, r.text) for r in got] == [("web", "web one"), ("web", "web two "), ("news", "news one"), ("news", "news two ")]
    with pytest.raises(ValueError, match="no corpus in en for: dev, talks"):
        corpus.read_corpora(spark, str(tmp_path), ["web", "talks", "dev"], "en")
    raw = corpus.read_lines(spark, f"{tmp_path}/web.en").orderBy("line_no").collect()
    assert [r.text for r in raw] == ["web one", "web\ttwo\r"]


def test_staged_tables_are_deleted_by_their_owner(spark):
    from pathlib import Path

    root = Path(staging.staging_root(spark)) / "sentloom"
    with staging.staged_tables(spark):
        kept = staging.stage(spark.range(3), "owned")
        assert kept.count() == 3 and list(root.glob("owned-*"))
    assert not list(root.glob("owned-*"))


def test_sides_of_an_empty_table(spark, tmp_path):
    src, tgt = sinks.write_sides(spark.createDataFrame([], "line_no bigint, src string, tgt string"), str(tmp_path / "none"))
    assert corpus.read_parallel(spark, src, tgt, "c", "l1", "l2").count() == 0


def test_line_numbers_over_many_ranges(spark):
    """More borders than are compared at once; ids far apart, some equal."""
    rows = [((i * i * 977) % 100_003 * 10**9, "en" if i % 4 else "de", "s", "\n".join("x" * (j + 1) for j in range(i % 3 + 1))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, text string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        got = number_lines(df.coalesce(4)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for lang in ("en", "de"):
        own = sorted((r for r in got if r.lang == lang), key=lambda r: r.line_no)
        assert [r.line_no for r in own] == list(range(1, len(own) + 1))
        assert [r.doc_id for r in own] == sorted(r.doc_id for r in own)
