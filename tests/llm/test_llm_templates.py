import re

import pytest
from pyspark.sql import functions as F

from skuflow.llm import templates as T


@pytest.fixture(scope="session")
def bench(spark):
    rows = [(1, "If Anna walks 12 km in 3 hours, how far does she get in one hour at the same speed?"),
            (2, "the quick brown fox jumps over the lazy dog near the quiet river bank today"),
            (2, "the quick brown fox jumps over the lazy dog near the quiet river bank today"),
            (3, "too short"), (4, None), (5, ""),
            (6, "seven ships sail from Riga to Oslo with 40 kg of salt and return with 50 kg of fish")]
    return spark.createDataFrame([(*r, "clash") for r in rows], "item_id long, text string, doc_id string")


def found(make_docs, bench, rows):
    docs = make_docs(rows).withColumnRenamed("lang", "item_id")
    return sorted({(r["doc_id"], r["item_id"]) for r in T.find_items(docs, bench).collect()}, key=str)


FOX = "the quick brown fox jumps over the lazy dog near the quiet river bank today"
FILL = "some other words go here and there again. "


def test_verbatim_and_reparameterised_items_are_found(make_docs, bench):
    rows = [(10, FILL + FOX.upper() + " " + FILL), (11, FILL * 30 + FOX.replace(" ", "\n") + "!"),
            (12, FILL + "If Boris walks 95 km in 4 hours, how far does he not get"),
            (13, FILL + "if Boris walks 95 miles in 4 days, how far does she get in one hour at the same speed? " + FILL),
            (14, FILL + "seven ships sail from Kiel to Cork with 70 kg of salt and return with 80 kg of fish"),
            (15, FILL * 50), (16, FOX[:40])]
    assert found(make_docs, bench, rows) == [(10, 2), (11, 2), (13, 1), (14, 6)]


def test_slots_must_map_one_to_one(spark, make_docs):
    item = "take 5 apples and 5 pears and 7 plums then add 5 apples and 7 plums again in all"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    good = item.replace("5", "31").replace("7", "12")
    torn = "take 5 apples and 6 pears and 7 plums then add 8 apples and 9 plums again in all"
    merged = item.replace("7", "5")
    assert found(make_docs, bench, [(1, good), (2, torn), (3, merged), (4, item)]) == [(1, 1), (4, 1)]


def test_four_fifths_of_the_windows_are_needed(make_docs, bench):
    words = FOX.split()
    at_end, in_middle = [*words[:-2], "x", "y"], [*words[:7], "x", *words[8:]]
    assert found(make_docs, bench, [(1, " ".join(at_end)), (2, " ".join(in_middle))]) == [(1, 2)]
    extra = [*words[:1], "x", *words[1:]]  # the rest lines up with another shift
    assert found(make_docs, bench, [(3, " ".join(extra))]) == [(3, 2)]


def test_odd_rows(spark, make_docs, bench):
    rows = [(1, None), (2, ""), (3, "| *** |"), (None, FOX), (None, "clean text"), (4, FOX), (4, FOX), (4, "clean"),
            (5, "word " * 40_000 + FOX)]
    assert found(make_docs, bench, rows) == [(4, 2), (5, 2), (None, 2)]
    assert found(make_docs, bench, []) == [] and found(make_docs, bench.limit(0), rows) == []
    docs = make_docs(rows)
    clean = T.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted([(r["doc_id"], r["text"]) for r in clean.collect()], key=str) == sorted(
        [(1, None), (2, ""), (3, "| *** |"), (None, "clean text"), (4, "clean")], key=str)


def test_a_large_benchmark_is_joined_by_shuffle(make_docs, bench, monkeypatch):
    rows = [(1, FILL + FOX), (2, FILL)]
    monkeypatch.setattr(T, "MAX_BROADCAST", 0)
    assert found(make_docs, bench, rows) == [(1, 2)]


def test_template_and_plain_words_line_up(make_docs):
    texts = ["Anna and Boris paid $3.50, or 4 km.", "x 5km y", "at 10:30 by Mr. Smith -- 7 % of 1,000", "a  <b> |c|"]
    got = make_docs(list(enumerate(texts))).select(
        T._words(T.template_text(F.col("text"))).alias("t"), T._words(T.plain_text(F.col("text"))).alias("p")).collect()
    for r in got:
        assert len(r["t"]) == len(r["p"])
    assert got[0]["t"] == ["anna", "and", T.NAME, "paid", T.NUMBER, "or", T.NUMBER, T.UNIT]
    assert got[1]["t"] == ["x", T.NUMBER + T.UNIT, "y"]


def test_equals_brute_force_on_the_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))

    def words(t):
        return re.sub(r"[^\w\s]+", "", (t or "").lower()).split()

    items = {r["item_id"]: words(r["text"]) for r in bench.collect()}
    want = set()
    for r in docs.collect():
        text = f" {' '.join(words(r['text']))} "
        want |= {(r["doc_id"], i) for i, w in items.items() if f" {' '.join(w)} " in text}
    got = {(r["doc_id"], r["item_id"]) for r in T.find_items(docs, bench).collect()}
    assert want and want <= got and len(got) <= 1.1 * len(want)


def test_copies_in_other_case_punctuation_and_wrapping_are_found(spark, make_docs):
    item = ("Near Riga, Anna Berg sold the Golden Ship to Boris; then Carl, her uncle, left for Oslo. "
            "There Dora met Emil, and Frida paid Gustav.")
    bench = spark.createDataFrame([(1, item), (2, "Die Straße nach Ulm, sagte Hans, ist für große Wagen zu eng.")],
                                  "item_id long, text string")
    bare = re.sub(r"[.,;]", "", item)
    forms = [item, item.lower(), item.upper(), item.title(), bare, bare.lower(), bare.title(),
             item.replace(" ", "\n"), item.replace(" ", "  \r\n"), item.replace(" ", " ")]
    rows = [(k, FILL + f + " " + FILL) for k, f in enumerate(forms)]
    rows.append((99, "DIE STRASSE NACH ULM SAGTE HANS IST FÜR GROSSE WAGEN ZU ENG"))
    assert found(make_docs, bench, rows) == [*((k, 1) for k in range(len(forms))), (99, 2)]


def test_every_item_of_the_tables_is_found_in_any_form(spark, make_docs):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    forms = [lambda t: t, str.lower, str.title, lambda t: re.sub(r"[.,;]", "", t), lambda t: t.replace(" ", "\n")]
    items = bench.collect()
    rows = [(1000 * k + r["item_id"], form(r["text"])) for k, form in enumerate(forms) for r in items]
    got = set(found(make_docs, bench, rows))
    assert {(1000 * k + r["item_id"], r["item_id"]) for k in range(len(forms)) for r in items} <= got


def test_twins_with_names_at_sentence_starts_and_units_in_the_singular_are_found(spark, make_docs):
    items = ["Anna has 5 apples. Boris has 3 apples. How many apples do Anna and Boris have together?",
             "A pump runs for 1 hour at 5 liters per minute and then for 2 hours at 1 liter per minute until done",
             "Anna paid. Boris left?\nAnna stayed for 2 feet of rope. Boris came."]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    twins = ["Carla has 9 apples. Dmitri has 4 apples. How many apples do Carla and Dmitri have together?",
             "A pump runs for 3 hours at 7 liters per minute and then for 1 hour at 3 liters per minute until done",
             "Carla paid. Dmitri left?\nCarla stayed for 1 foot of rope. Dmitri came."]
    torn = "Carla has 9 apples. Dmitri has 4 apples. How many apples do Eve and Fred have together?"
    assert found(make_docs, bench, [*enumerate(twins), (7, torn)]) == [(0, 0), (1, 1), (2, 2)]


def test_one_altered_value_costs_its_own_windows_only(spark, make_docs):
    long = ("In 2010 the town of Riga built a bridge over the wide river and in 2010 it also opened two schools "
            "for the children of the harbour while the old mill that had burned down was left as it stood until "
            "the winter of 2010 when a storm carried the last of its walls away and nobody asked for them again")
    item = "take 5 apples and 3 pears from the basket and give 5 apples to one and 3 pears to the other child"
    bench = spark.createDataFrame([(1, long), (2, item)], "item_id long, text string")
    rows = [(1, long.replace("2010 it", "2011 it")), (2, long.replace("Riga", "Rome").replace("2010 when", "1999 when")),
            (3, item.replace("5", "4").replace("3", "4")), (4, item.replace("5", "8").replace("3", "9")),
            (5, "take 5 apples and 6 pears from the basket and give 7 apples to one and 8 pears to the other child")]
    assert found(make_docs, bench, rows) == [(1, 1), (2, 1), (3, 2), (4, 2)]


def test_short_items_and_scripts_without_spaces_are_searched(spark, make_docs):
    items = ["Who wrote Hamlet?", "Define osmosis briefly.", "Photosynthesis", "中国的首都是哪座城市?", "東京", "ใครเป็นผู้เขียน",
             "What is 2 + 2?", "...", "小明有5个苹果,小红有3个苹果,他们一共有几个苹果?"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [(k, FILL + t + " " + FILL) for k, t in enumerate(items)]
    rows += [(20, FILL + "who wrote\nhamlet"), (21, "Who wrote Faust? Define it briefly."), (22, "问题中国的首都是哪座城市呢"),
             (23, "what is 2 3"), (24, "小明有8个苹果,小红有9个苹果,他们一共有几个苹果"), (25, "who"), (26, "")]
    want = [(k, k) for k in range(len(items)) if k != 7]
    assert found(make_docs, bench, rows) == sorted([*want, (20, 0), (22, 3), (24, 8)], key=str)
