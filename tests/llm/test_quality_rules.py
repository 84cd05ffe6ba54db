"""Counts against a plain version, and the line rules."""

import random
import re

from sentloom.llm import quality_rules

SPLIT = r"[\x20\x09-\x0D]+"


def plain(text):
    text = text or ""
    words = [w for w in re.split(SPLIT, text) if w]
    runs = {}
    for i in range(len(words) - 4):
        runs.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {j for at in runs.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


def check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain(t), repr(t)[:200]
        assert not (r["kept"] and r["base_failed"])
    return got


def test_counts(spark):
    rng = random.Random(1)
    texts = [None, "", " ", "\n\n", "a", "a b c d e", "a b c d e a b c d e", "x " * 50, "a\nb\na\n\n \na", "#*$%&|<>",
             "ä🙂 b c d", "\x1c a\x1db", "a\r\nb\r\na", "w " * 30_000]
    texts += [" ".join(rng.choices("abc", k=rng.randint(5, 60))) for _ in range(60)]
    texts += ["\n".join(rng.choices(["one two. three", "four five six seven eight nine", "", "#!", " "], k=12)) for _ in range(20)]
    check(spark, texts)


def test_counts_of_the_table(spark, sf):
    check(spark, [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])


def test_lines(spark):
    clean = "This is a plain sentence with enough words in it. And one more follows here."
    texts = {
        "clean": clean, "notice": f"{clean}\nCopyright © 2020\nAll rights reserved.", "menu": "Home | News | Sport | Contact | Login | Help | About | Map | Shop | Jobs",
        "symbols": " ".join(f"word{i}%%%" for i in range(20)), "shouts": " ".join(f"WORD{i}!!" for i in range(20)),
        "half": clean + "\n" + "Home | About\n" * 2, "unmarked": "these are more than five words without any mark at all in the line",
    }
    docs = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    got = {name: r for name, r in zip(texts, sorted(quality_rules.quality_rules(docs).collect(), key=lambda r: r["doc_id"]))}
    assert {n for n, r in got.items() if r["kept"]} == {"clean", "notice", "half", "unmarked"}
    assert got["notice"]["cleaned"] == clean
    assert got["half"]["cleaned"] == clean + "\n"


def test_odd_rows(spark):
    rows = [(1, "a b", 5, True), (1, "a b", 5, True), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept boolean")
    got = quality_rules.quality_rules(docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "None"]
    assert not any(r["kept"] for r in got)
    assert quality_rules.quality_rules(docs.limit(0)).collect() == []


def test_main_path_is_native(spark, sf):
    plan = quality_rules.quality_rules(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
