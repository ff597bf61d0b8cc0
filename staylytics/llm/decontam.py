"""Benchmark decontamination by template windows, in DataFrame functions only.

A word becomes its template: a number, a unit after a number, or a name (a capitalised word
inside a sentence) turns into a typed placeholder, anything else into its lower-case letters. A
capitalised word at a sentence's start may be a name or not, so windows with one are hashed both ways. Windows
of five template words are hashed and joined with the windows of the benchmark. Matches of
a document and an item lie on diagonals (document position minus item position), and a word put in or left out moves
what follows to a neighbouring one. So an item is laid over the document in pieces, by a band of diagonals where most of its
windows agree: there the share of the item's windows is counted, and the slots are compared, each by the windows over it. Each slot value of the item must stand for one value of the
document throughout, so a question asked again with other numbers is found and an accidental
frame is not. Where most slots hold the item's own values it is a copy, and single changes don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics.llm.common import column_type
from staylytics.sources import materialize

#: Unit words that become a placeholder after a number.
UNITS = (
    "mm cm m km in ft yd mi g kg lb oz mg ml l s sec min h hr day days hour hours minute minutes second seconds "
    "week weeks month months year years meter meters metre metres mile miles foot feet inch inches gram grams "
    "kilogram kilograms pound pounds ounce ounces liter liters litre litres percent dollar dollars euro euros cent cents"
).split()
NUMBER, NAME, UNIT = "\u0001", "\u0002", "\u0003"
CAPITALISED = r"^\p{Lu}\p{Ll}"
#: Signs taken off both ends of a word before anything is compared.
SIGNS = ".,;:!?\"'`´‘’“”„«»‹›…()[]{}<>|*#&%$€£@^~_/\\=+-–—¿¡"
#: A table of up to so many short rows may be sent to every task; a larger one is joined by shuffle.
BROADCAST_ROWS = 1_000_000


def _words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _bare(words: Column | str) -> Column:
    """The words without the punctuation around them; a word of signs only stays as it is."""
    return F.transform(words, lambda w: F.coalesce(F.nullif(F.btrim(w, F.lit(SIGNS)), F.lit("")), w))


def _is_number(word: Column) -> Column:
    return F.substring(word, 1, 1).between("0", "9") & word.rlike(r"^[0-9][0-9.,:/]*$")


def _templates(words: str, bare: str, names: bool = True) -> Column:
    """The template of each word, with the placeholder that it and its left neighbour call for."""

    def one(w: Column, i: Column) -> Column:
        low = F.lower(w)
        previous = F.element_at(F.col(bare), i)
        ends = F.element_at(F.col(words), i).rlike(r"[.!?:;|]\W*$")
        is_name = (low != w) & (i > 0) & w.rlike(CAPITALISED) & ~F.when(i > 0, ends).otherwise(F.lit(True))
        is_unit = (i > 0) & F.when(i > 0, _is_number(previous)).otherwise(F.lit(False)) & low.isin(UNITS)
        known = F.when(_is_number(w), NUMBER)
        return (known.when(is_name, NAME) if names else known).when(is_unit, UNIT).otherwise(low)

    return F.transform(bare, one)


def templates(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, words, bare, template): words, bare words and templates, arrays of equal length; empty for a null or blank text."""
    rows = df.select(F.col(id_column).alias("id"), _words(F.col(text_column)).alias("words"))
    rows = rows.select("id", "words", _bare("words").alias("bare"))
    return rows.select("id", "words", "bare", _templates("words", "bare").alias("template"))


def _capitals(bare: str, template: str) -> Column:
    """The template with every capitalised word a name, also where a sentence starts."""
    is_name = lambda w: (F.lower(w) != w) & w.rlike(CAPITALISED)
    return F.transform(bare, lambda w, i: F.when(is_name(w), NAME).otherwise(F.element_at(F.col(template), i + 1)))


def _windows(n: int, template: str = "template") -> Column:
    """A hash for each window of ``n`` template words, in order."""
    at = F.sequence(F.lit(1), F.greatest(F.size(template) - n + 1, F.lit(1)))
    hashed = F.transform(at, lambda i: F.xxhash64(*[F.element_at(F.col(template), i + k) for k in range(n)]))
    return F.when(F.size(template) >= n, hashed).otherwise(F.array().cast("array<bigint>"))


def _literals(template: str, i: Column, n: int) -> Column:
    """How many words of the window at ``i`` are no placeholders."""
    place = F.array(*[F.lit(x) for x in (NUMBER, NAME, UNIT)])
    return F.size(F.filter(F.slice(F.col(template), i + 1, n), lambda t: ~F.array_contains(place, t)))


def _telling(n: int, literals: int) -> Column:
    """(item_at, hash, unnamed hash, hash with capitals) of the windows with at least so many words that are no placeholders.

    The last one is null where names at sentence starts leave too few such words; the item's own start always has one.
    """
    capital = lambda i: F.when((i == 0) | (_literals("capitals", i, n) >= literals), F.element_at(F.col("capital_hashes"), i + 1))
    one = lambda h, i: F.struct(i.alias("item_at"), h.alias("hash"), F.element_at(F.col("unnamed"), i + 1).alias("other"), capital(i).alias("capital"), (_literals("template", i, n) >= literals).alias("plain"))
    return F.filter(F.transform("hashes", one), lambda w: w["plain"])


def few(df: DataFrame) -> DataFrame:
    """To every task if it is small, else left to a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def alignments(hits: DataFrame, share: float) -> DataFrame:
    """(id, item, kind, single, at, n_windows, n_matched, windows): where at least ``share`` of an item's windows agree.

    One row for each diagonal that is enough by itself, and one for each band of diagonals that is: bands
    are as wide as the item and overlap by half, so segments that words put in or left out have moved by up to half
    the item's length against each other are counted together. ``windows`` lists (item_at, at): in a band each window takes the diagonal
    that most windows of the band are on. Kind 0 goes by names inside sentences only, kind 1 also takes windows
    that agree if capitalised words at sentence starts are names.
    """
    key, need = ["id", "item", "n_windows", "n_words"], F.ceil(F.col("n_windows") * F.lit(share))
    enough = hits.groupBy(*key).agg(F.countDistinct("item_at").alias("n")).where(F.col("n") >= need).select("id", "item")
    close = hits.join(enough, ["id", "item"]).groupBy(*key, "item_at", "at").agg(F.min("kind").alias("least"))
    close = materialize(close.withColumn("kind", F.explode(F.sequence("least", F.lit(1)))), "close")
    key = [*key, "kind"]
    lines = close.groupBy(*key, "at").agg(F.count("*").alias("n"))
    half = F.array(F.lit(0), F.floor(F.col("n_words") / 2).cast("int"))
    bands = close.join(lines.select("id", "item", "kind", "at", "n"), ["id", "item", "kind", "at"]).select("*", F.posexplode(half).alias("side", "by"))
    bands = bands.withColumn("band", F.floor((F.col("at") + F.col("by")) / F.col("n_words")))
    bands = bands.groupBy(*key, "side", "band", "item_at").agg(F.max(F.struct("n", (-F.col("at")).alias("at"), "least")).alias("m"))
    bands = bands.select(*key, "side", "band", "item_at", (-F.col("m.at")).alias("at"), F.col("m.least").alias("least"))
    single = close.join(lines.where(F.col("n") >= need).select("id", "item", "kind", "at"), ["id", "item", "kind", "at"])
    single = single.select(*key, F.lit(-1).alias("side"), F.col("at").cast("long").alias("band"), "item_at", "at", "least")
    both = single.union(bands.select(single.columns)).groupBy(*key, "side", "band")
    both = both.agg(F.sort_array(F.collect_list(F.struct("item_at", "at"))).alias("windows"), F.max("least").alias("least"))
    both = both.withColumn("n_matched", F.size("windows")).where((F.col("n_matched") >= need) & (F.col("least") == F.col("kind")))
    return both.select("id", "item", "kind", (F.col("side") < 0).alias("single"), F.element_at("windows", 1)["at"].alias("at"), "n_windows", "n_matched", "windows")


def _values(i: Column, n: int) -> Column:
    """The words of the document that may stand at word ``i`` of the item: by each matched window over it, else by the nearest one."""
    over = F.filter("windows", lambda w: (w["item_at"] <= i) & (w["item_at"] > i - n))
    away = F.transform("windows", lambda w: F.struct(F.abs(w["item_at"] - i).alias("by"), w["at"].alias("at")))
    at = F.when(F.size(over) > 0, F.transform(over, lambda w: w["at"])).otherwise(F.array(F.array_min(away)["at"]))
    places = F.filter(F.array_distinct(F.transform(at, lambda d: d + i)), lambda x: (x >= 0) & (x < F.size("bare")))
    return F.transform(places, lambda x: F.element_at(F.col("bare"), x + 1))


def _common(slots: Column) -> Column:
    """The words that may stand for all of the slots."""
    return F.aggregate(slots, slots[0]["is"], lambda held, s: F.array_intersect(held, s["is"]))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = 5,
    share: float = 0.8,
    literals: int = 2,
) -> DataFrame:
    """(id, item, n_windows, n_matched, share, at, n_slots, reworded): one row for each item found in a document.

    ``share`` is the part of the item's windows that agree in one band of diagonals, at least the given one
    (windows of fewer than ``literals`` words besides placeholders tell nothing and are not counted);
    ``at`` is the word of the document where the item begins (it may be negative if its start is cut off); ``n_slots`` counts the compared
    placeholders, ``reworded`` those whose value differs. Several places of one item in a document give the best one,
    then the first. An item shorter than a window, null or empty finds nothing, and so does
    a null or empty text. Repeated rows of a document or an item (by id) count once. Null ids match
    nothing. Empty tables give an empty table; other columns are not read.
    """
    items = templates(benchmark, item_column, item_text_column).where("id is not null").dropDuplicates(["id", "words"])
    items = items.withColumn("named", F.concat(F.array(F.lit(NAME)), F.slice("template", 2, 1 << 30)))
    items = items.withColumn("plain", _templates("words", "bare", names=False))
    items = items.withColumn("capitals", _capitals("bare", "template")).withColumn("capital_hashes", _windows(window, "capitals"))
    items = items.withColumns({"hashes": _windows(window), "unnamed": _windows(window, "plain"), "starts": _windows(window, "named")})
    items = items.select(F.col("id").alias("item"), F.col("bare").alias("item_bare"), "template", "capitals", "starts", _telling(window, literals).alias("windows"))
    items = materialize(items, "items")
    # a document in capitals or without them shows no names, and inside its sentences an item's first word may look like one
    start = F.when(F.col("w.item_at") == 0, F.get("starts", F.lit(0))).otherwise(F.col("w.hash"))
    grams = items.select("item", "starts", F.size("template").alias("n_words"), F.size("windows").alias("n_windows"), F.explode("windows").alias("w"))
    known = F.array_distinct(F.array("w.hash", "w.other", start))
    kinds = F.array(known, F.array_except(F.array_compact(F.array("w.capital")), known))
    grams = grams.select("item", "n_windows", "n_words", F.col("w.item_at").alias("item_at"), F.posexplode(kinds).alias("item_kind", "hash"))
    grams = grams.withColumn("hash", F.explode("hash"))
    grams = few(materialize(grams, "windows"))
    rows = templates(docs.where(F.col(id_column).isNotNull()), id_column, text_column)
    rows = rows.select("id", "template", _capitals("bare", "template").alias("capitals"))
    # one row per window before anything is hashed: columns of rows are compiled, functions within arrays aren't
    at = F.when(F.size("template") >= window, F.sequence(F.lit(0), F.size("template") - window))
    rows = rows.select("id", "template", "capitals", F.explode(at).alias("doc_at"))
    hashes = [F.xxhash64(*[F.get(c, F.col("doc_at") + k) for k in range(window)]).alias(a) for c, a in (("template", "h"), ("capitals", "c"))]
    rows = rows.select("id", "doc_at", *hashes)
    twofold = F.when(F.col("h") == F.col("c"), F.array("h")).otherwise(F.array("h", "c"))
    hashed = rows.select("id", "doc_at", F.posexplode(twofold).alias("doc_kind", "hash"))
    hits = hashed.join(grams, "hash").withColumn("kind", F.greatest("item_kind", "doc_kind"))
    hits = hits.select("id", "item", "item_at", "n_windows", "n_words", (F.col("doc_at") - F.col("item_at")).alias("at"), "kind")
    best = materialize(alignments(materialize(hits, "hits"), share), "alignments")

    # only documents with a hit are read again, for the values in their slots
    found = few(materialize(best.select("id").distinct(), "found"))
    texts = templates(docs.join(found.withColumnRenamed("id", id_column), id_column, "left_semi"), id_column, text_column)
    texts = texts.dropDuplicates(["id", "bare"]).select("id", "bare")
    laid = best.join(items.select("item", "item_bare", "template", "capitals"), "item").join(texts, "id")
    slots = F.filter(
        F.transform("template", lambda t, i: F.struct(t.isin(NUMBER, NAME, UNIT).alias("own"), F.element_at(F.col("item_bare"), i + 1).alias("of"), _values(i, window).alias("is"), i.alias("i"))),
        lambda s: (s["own"] | ((F.col("kind") == 1) & (F.element_at(F.col("capitals"), s["i"] + 1) == NAME))) & (F.size(s["is"]) > 0),
    )
    laid = laid.withColumn("slots", slots)
    values = F.array_distinct(F.transform("slots", lambda s: s["of"]))
    one = F.forall(values, lambda v: F.size(_common(F.filter("slots", lambda s: s["of"] == v))) > 0)
    laid = laid.select("*", F.size("slots").alias("n_slots"), one.alias("consistent"))
    other = lambda s: ~F.exists(s["is"], lambda x: F.lower(x) == F.lower(s["of"]))
    laid = laid.withColumn("reworded", F.size(F.filter("slots", other)))
    own = F.filter("slots", lambda s: s["own"])
    same = (F.col("n_slots") - F.col("reworded") >= F.col("n_slots") * F.lit(share)) & (F.size(own) - F.size(F.filter(own, other)) >= F.size(own) * F.lit(share))
    kept = laid.where(F.col("consistent") | same).groupBy("id", "item").agg(
        F.max(F.struct("n_matched", (-F.col("kind")).alias("kind"), "single", (-F.col("at")).alias("at"), "n_windows", "n_slots", "reworded")).alias("b")
    )
    return kept.select(
        F.col("id").cast(column_type(docs, id_column)).alias(id_column),
        F.col("item").cast(column_type(benchmark, item_column)).alias(item_column),
        F.col("b.n_windows").cast("long").alias("n_windows"),
        F.col("b.n_matched").cast("long").alias("n_matched"),
        (F.col("b.n_matched") / F.col("b.n_windows")).alias("share"),
        (-F.col("b.at")).cast("long").alias("at"),
        F.col("b.n_slots").cast("long").alias("n_slots"),
        F.col("b.reworded").cast("long").alias("reworded"),
    )
