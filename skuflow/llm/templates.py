"""Benchmark decontamination by template windows (op 7).

Letters are lower-cased and punctuation goes; numbers and units after numbers
(in singular or plural) become typed placeholders, so that a question and its
re-parameterised twin have the same template words.  A window has up to three templates: without
names, which any copy shares whatever its case, punctuation and line wrapping;
with every capital word as a name, also one that opens a sentence; and with
the capital words inside a sentence only.  Windows of five template words of the
benchmark items are joined by hash with those of the documents.  Where document
and item windows line up (the same difference of positions), each placeholder value of the item has one partner in the document,
the commonest; windows with another value are dropped, unless it is the item's
own.  Two item values may share a partner, but not one that is unchanged for
the other.  An item is found in a document if at least 0.8 of its windows are
left in its line-ups.

A first pass hashes each word once and windows from their words' hashes, and keeps
the texts that share enough window hashes with one item.  The benchmark's hashes
(with id and place, about 40 bytes each) are broadcast if they number at most
``MAX_BROADCAST``, which is counted first, and shuffled beyond it.  Line-ups and
placeholder values are worked out for these texts alone, in joins whose sizes
adaptive execution measures.

Items with fewer than five words are one window of plain words, as long as the
item; its words must be in the document in this order, without placeholders.
In scripts without spaces each letter is a word.

Defined results: items without a letter or digit, null and empty texts match nothing; benchmark rows that repeat an id and
text are one item, an id with two texts is two; rows that repeat an id and text are one document;
a null doc_id is kept apart by its text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.session import materialize

WINDOW = 5
SHARE = 0.8
MAX_BROADCAST = 1_000_000

# Placeholders are private-use letters, which prose does not hold.
NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"
UNITS = ("km", "m", "cm", "mm", "mi", "ft", "in", "yd", "kg", "g", "mg", "lb", "oz", "t", "l", "ml", "cl", "s", "sec",
         "min", "h", "hr", "mph", "kmh", "kb", "mb", "gb", "tb", "kw", "kwh", "hz", "mile", "foot", "feet", "inch",
         "inches", "yard", "meter", "metre", "kilometer", "kilometre", "centimeter", "centimetre", "millimeter",
         "millimetre", "gram", "kilogram", "milligram", "pound", "ounce", "ton", "tonne", "liter", "litre",
         "milliliter", "millilitre", "gallon", "quart", "pint", "cup", "acre", "hectare", "second", "minute", "hour",
         "day", "week", "month", "year", "decade", "century", "centuries", "dollar", "euro", "cent", "penny",
         "pennies", "pence", "percent", "degree", "byte", "watt", "kilowatt", "volt", "amp", "joule", "calorie")
ONE_OF = {"feet": "foot", "inches": "inch", "centuries": "century", "pennies": "penny", "pence": "penny"}
SPACE = r"\s\p{Z}"
WHITE = rf"[{SPACE}]+"
OTHER_SPACE = r"[\t\x0B\f\r\u00A0\u1680-\u3000]"  # holds all of SPACE but blanks and newlines; quick ranges
# Thai, Lao, Myanmar, Khmer, kana, Han
UNSPACED = (r"[\u0E01-\u0EFF\u1000-\u109F\u1780-\u17FF\u3005-\u3007\u3040-\u30FF\u31F0-\u31FF\u3400-\u4DBF"
            r"\u4E00-\u9FFF\uA9E0-\uA9FE\uAA60-\uAA7F\uF900-\uFAFF\uFF66-\uFF9F\x{1AFF0}-\x{1B16F}\x{20000}-\x{3FFFF}]")
# a capital word after a lower-case letter, ',' or ';'; on text without punctuation, any capital word
# (the capital is looked at first, as most places have none)
INSIDE = rf"(?=\p{{Lu}})(?<=[\p{{Ll}},;][{SPACE}]{{1,2}})\p{{Lu}}\p{{Ll}}[\p{{L}}'-]*"
CAPITAL = r"(?=\p{Lu})(?<![\p{L}\p{N}])\p{Lu}[\p{L}\p{N}]*\p{Ll}[\p{L}\p{N}]*"


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}{NAME}-{UNIT}{SPACE}]+", "")


def _lower(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("\u00df"), F.lit("ss"))  # capitals of it are SS


def _typed(text: Column) -> Column:
    """Numbers and units of text without capitals and punctuation as placeholders."""
    t = F.regexp_replace(text, r"\d+", NUMBER)
    unit = rf"{NUMBER}([{SPACE}]*)(?:{'|'.join(UNITS)})s?(?![\p{{L}}\p{{N}}])"
    return F.regexp_replace(t, unit, f"{NUMBER}$1{UNIT}")


def _named_inside(text: Column) -> Column:
    return _lower(_strip(F.regexp_replace(text, INSIDE, NAME)))


def template_text(text: Column) -> Column:
    """The text with placeholders, as many white-space words as ``plain_text``."""
    return _typed(_named_inside(text))


def plain_text(text: Column) -> Column:
    return _lower(_strip(text))


def _singular(word: Column) -> Column:
    """The plain word of a unit, with or without its number, in the singular."""
    for many, one in ONE_OF.items():
        word = F.regexp_replace(word, rf"(?<!\p{{L}}){many}$", one)
    return F.regexp_replace(word, r"(?<=\p{L}{2})s$", "")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITE), "")


def _spaced(text: Column) -> Column:
    """Letters of scripts without spaces as words of their own."""
    far = text.rlike(r"[\u0E01-\x{3FFFF}]")  # one range, which most texts are below
    return F.when(far & text.rlike(UNSPACED), F.regexp_replace(text, UNSPACED, " $0 ")).otherwise(text)


def _split(text: Column) -> Column:
    """Words of a text whose white space is all single blanks."""
    return F.array_remove(F.split(text, " "), "")


def _forms(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``w``, one struct in an array, so that its words are made once
    and not for every window: plain words, and template words without names, with
    every capital word, and with those inside a sentence as names."""
    def step(now: DataFrame, left: list[str], **made: Column) -> DataFrame:
        # one step a projection: each text is made once, not once for every use
        return now.select(*keep, *left, *[c.alias(name) for name, c in made.items()])

    text, bare = F.col("text"), F.col("bare")
    now = step(df, [], text=_spaced(text))
    now = step(now, [], text=F.replace(text, F.lit("\n"), F.lit(" ")))
    now = step(now, [], text=F.when(text.rlike(OTHER_SPACE), F.regexp_replace(text, f"[{SPACE}]", " ")).otherwise(text))
    now = step(now, ["text"], bare=_strip(text))
    now = step(now, [], plain=_lower(bare), inside=F.when(text.rlike(INSIDE), _named_inside(text)),
               any=F.when(bare.rlike(CAPITAL), _lower(F.regexp_replace(bare, CAPITAL, NAME))))

    def words(c: str) -> Column:
        return _split(F.when(F.col(c).rlike(r"\d"), _typed(F.col(c))).otherwise(F.col(c)))
    return step(now, [], w=F.array(F.struct(
        _split(F.col("plain")).alias("p"),
        # null without a number: the plain words
        F.when(F.col("plain").rlike(r"\d"), _split(_typed(F.col("plain")))).alias("t"),
        words("any").alias("any"), words("inside").alias("inside"))))


def window_hashes(df: DataFrame, keep: list[str], width: int = WINDOW, short: Iterable[int] | None = None,
                  placed: bool = False) -> DataFrame:
    """``keep``, pos and hash of the windows that ``windows`` cuts, from hashes of
    single words: no window is written out.  Without ``placed`` each hash once,
    and no pos."""
    def numbered(words: Column) -> Column:
        return F.transform(words, lambda x: F.xxhash64(x))

    def cut(w: Column) -> Column:
        # word hashes of each form, once; plain ones also for short items
        held = F.array(F.struct(*[numbered(w[f]).alias(f) for f in ("p", "t", "any", "inside")]))

        def hashes(h: Column) -> Column:
            size = F.size(h["p"])

            def of(words: Column, n: int, wanted: Column) -> Column:
                def at(i: Column) -> Column:
                    made = F.xxhash64(F.lit(n), *[F.get(words, i + k) for k in range(n)])
                    return F.struct((i + 1).alias("pos"), made.alias("hash")) if placed else made
                made = F.transform(F.sequence(F.lit(0), F.greatest(size - n, F.lit(0))), at)
                none = "array<struct<pos:int,hash:bigint>>" if placed else "array<bigint>"
                return F.coalesce(F.when(wanted, made), F.expr(f"cast(array() as {none})"))

            typed = F.coalesce(h["t"], h["p"])
            forms = [of(words, width, (size >= width) & (F.size(words) == size)) for words in (typed, h["any"], h["inside"])]
            small = range(1, width) if short is None else short
            less = [of(h["p"], n, (size == n) if short is None else (size >= n)) for n in small]
            return F.array_distinct(F.concat(*forms, *less))
        return F.transform(held, hashes)[0]

    found = _forms(df, keep).select(*keep, F.explode(F.transform("w", cut)[0]).alias("hash"))
    return found.select(*keep, "hash.*") if placed else found


def windows(df: DataFrame, keep: list[str], width: int = WINDOW, short: Iterable[int] | None = None) -> DataFrame:
    """``keep``, pos, hash of every window in each of its templates; template and
    plain words of those that hold placeholders (null for others).  Also windows of
    ``short`` plain words; with None, texts of fewer than ``width`` words are one."""
    def cut(w: Column) -> Column:
        count = F.size(w["p"]) - width + 1
        typed = F.coalesce(w["t"], w["p"])

        def of(words: Column, *others: Column) -> Column:
            def at(i: Column) -> Column:
                piece, plain = F.slice(words, i, width), F.slice(w["p"], i, width)
                made = F.struct(i.alias("pos"), F.xxhash64(piece).alias("hash"), F.when(
                    piece != plain, F.struct(piece.alias("t"), plain.alias("p"))).alias("slots"))
                for other in others:  # once, if templates are equal there
                    made = F.when(F.coalesce(piece != F.slice(other, i, width), F.lit(True)), made)
                return made
            cuts = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), at)
            if others:
                cuts = F.filter(cuts, lambda c: c.isNotNull())
            return F.when((count > 0) & (F.size(words) == F.size(w["p"])), cuts)

        def plain(size: Column, wanted: Column) -> Column:
            return F.when(wanted, F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(w["p"]) - size + 1, F.lit(1))), lambda i: F.struct(
                    i.alias("pos"), F.xxhash64(F.slice(w["p"], i, size)).alias("hash"), F.lit(None).alias("slots"))))

        if short is None:
            small = [plain(F.greatest(F.size(w["p"]), F.lit(1)), F.size(w["p"]).between(1, width - 1))]
        else:
            small = [plain(F.lit(n), F.size(w["p"]) >= n) for n in short]
        none = F.expr("cast(array() as array<struct<pos:int,hash:bigint,"
                      "slots:struct<t:array<string>,p:array<string>>>>)")
        return F.concat(*(F.coalesce(c, none) for c in (
            of(typed), of(w["any"], typed), of(w["inside"], typed, w["any"]), *small)))

    return (_forms(df, keep).select(*keep, F.explode(F.transform("w", cut)[0]).alias("w"))
            .select(*keep, F.col("w.pos").alias("pos"), F.col("w.hash").alias("hash"), F.col("w.slots").alias("slots")))


def _partners(values: Column) -> Column:
    """The document's value (b) that each item value (t, a) has at most positions of
    a line-up, at equal counts the same one.  A changed value does not take one that
    the line-up also leaves unchanged: the document then holds one parameter where
    the item holds two."""
    by_key = F.array_distinct(F.transform(values, lambda x: F.struct(x["t"].alias("t"), x["a"].alias("a"))))

    def most(key: Column) -> Column:
        own = F.filter(values, lambda x: (x["t"] == key["t"]) & (x["a"] == key["a"]))
        at = F.array_max(F.transform(own, lambda x: F.struct(
            F.size(F.array_distinct(F.transform(F.filter(own, lambda y: y["b"] == x["b"]), lambda y: y["at"])))
            .alias("n"), (x["a"] == x["b"]).alias("same"), x["b"].alias("b"))))
        return F.struct(key["t"].alias("t"), key["a"].alias("a"), at["b"].alias("b"))
    # one element, so that the partners are made once
    chosen = F.array(F.transform(by_key, most))
    return F.transform(chosen, lambda c: F.filter(c, lambda x: (x["a"] == x["b"]) | ~F.exists(
        c, lambda y: (y["t"] == x["t"]) & (y["a"] == y["b"]) & (y["b"] == x["b"]))))[0]


def find_items(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, share: float = SHARE) -> DataFrame:
    """doc_id, text_key, item_id, windows (matched), item_windows and slots
    (placeholder values compared), a row per document and item found in it."""
    known = benchmark.select("item_id", "text", F.xxhash64("text").alias("item_key")).distinct()
    items = windows(known, ["item_id", "item_key"], width)
    sizes = items.groupBy("item_id", "item_key").agg(F.countDistinct("pos").alias("item_windows"))
    sought = items.select("item_id", "item_key", F.col("pos").alias("item_pos"), "hash",
                          F.col("slots").alias("item_slots"))
    thin = docs.select("doc_id", F.col("text"), F.xxhash64("text").alias("text_key"))
    size = F.size(_words(plain_text(_spaced(F.col("text")))))
    short = sorted(r["n"] for r in known.select(size.alias("n")).where(F.col("n").between(1, width - 1))
                   .distinct().collect())  # width - 1 rows at most
    # first the texts that share enough windows with one item, by hashes alone
    marks = window_hashes(known, ["item_id", "item_key"], width, placed=True)
    if marks.count() <= MAX_BROADCAST:
        marks = F.broadcast(marks)
    shared = window_hashes(thin, ["text_key"], width, short).join(marks, "hash").groupBy(
        "text_key", "item_id", "item_key").agg(F.countDistinct("pos").alias("windows"))
    alike = shared["item_id"].eqNullSafe(sizes["item_id"]) & (shared["item_key"] == sizes["item_key"])
    # written, so that its size is known and the texts are not shuffled to meet it
    hit = materialize(shared.join(sizes, alike).where(F.col("windows") >= share * F.col("item_windows"))
                      .select("text_key").distinct(), "template-texts")
    # then the slots, for those texts alone
    cut = windows(thin.join(hit, "text_key", "left_semi"), ["doc_id", "text_key"], width, short)
    met = cut.join(sought, "hash").withColumn("shift", F.col("pos") - F.col("item_pos"))

    def value(t: Column, word: Column) -> Column:
        return F.when(t.contains(UNIT), _singular(word)).otherwise(word)

    # values of placeholders, item's and document's; template words are equal
    values = F.filter(F.zip_with(
        F.arrays_zip(F.col("item_slots.t").alias("t"), F.col("item_slots.p").alias("a"),
                     F.sequence(F.lit(0), F.size("item_slots.t") - 1).alias("k")), F.col("slots.p"),
        lambda x, b: F.struct(x["t"].alias("t"), value(x["t"], x["a"]).alias("a"), value(x["t"], b).alias("b"),
                              x["k"].alias("k"))),
        lambda x: x["t"].rlike(f"[{NAME}-{UNIT}]"))
    # with the item's position of each
    placed = F.transform(values, lambda x: x.withField("at", F.col("item_pos") + x["k"]))
    pair = ["doc_id", "text_key", "item_id", "item_key"]
    line = [*pair, "shift"]
    lined = (met.select(*line, F.struct("item_pos", F.coalesce(placed, F.expr(
        "cast(array() as array<struct<t:string,a:string,b:string,k:int,at:int>>)")).alias("values")).alias("window"))
        .groupBy(*line).agg(F.collect_set("window").alias("windows"))
        .withColumn("partners", _partners(F.array_distinct(F.flatten("windows.values")))))
    agreed = F.filter("windows", lambda w: F.forall(w["values"], lambda x: (x["a"] == x["b"]) | F.exists(
        "partners", lambda y: (y["t"] == x["t"]) & (y["a"] == x["a"]) & (y["b"] == x["b"]))))
    kept = lined.select(*pair, agreed.alias("windows"))
    pairs = F.size(F.array_distinct(F.transform(
        F.flatten("windows.values"), lambda x: F.struct(x["t"], x["a"], x["b"]))))
    found = (kept.select(*pair, F.explode("windows.item_pos").alias("item_pos"), pairs.alias("slots"))
             .groupBy(*pair, "item_pos").agg(F.max("slots").alias("slots"))
             .groupBy(*pair).agg(F.count(F.lit(1)).alias("windows"), F.max("slots").alias("slots")))
    enough = F.col("windows") >= share * F.col("item_windows")
    same = found["item_id"].eqNullSafe(sizes["item_id"]) & (found["item_key"] == sizes["item_key"])
    return found.join(sizes, same).where(enough).select(
        "doc_id", "text_key", found["item_id"], "windows", "item_windows", "slots")


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with their own columns."""
    # ids repeat in a mixed corpus: rows are matched by id and text
    hit = find_items(docs, benchmark, **options).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("__d"),
                        F.xxhash64("text").alias("__k"))
    return keyed.join(hit, F.col("__d").eqNullSafe(F.col("__id")) & (F.col("__k") == F.col("__key")),
                      "left_anti").select("row.*")
