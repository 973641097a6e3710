"""Quality rules from the divergence between a document's character and word distributions and those of languages.

A reference holds, per language, the histogram of character classes and of common words over all documents of that
language. A document is kept if some language's reference is near in both, by Jensen-Shannon distance; texts too short
for a histogram are judged by the plain rules alone. All of it is column expressions: one pass over the texts turns
each row into counts, which are written without the texts; references and verdicts come from these counts.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.common import SPACE
from tablejobs.storage import materialize

# Frequent function words of English, German, French and Spanish, in natural order.
COMMON_WORDS = tuple(
    "the of and to in a is it that for was on with as be by at this from or an are"
    " der die das und ist von zu mit den sich auf für nicht ein eine im dem auch als"
    " le la les des et un une du est en que qui dans pour par sur au plus pas avec"
    " el los las de y se del con no su lo como más o".split()
)
WORDS = tuple(dict.fromkeys(COMMON_WORDS))
#: Character classes besides ``lower`` and ``space``: name and the characters, for a regular expression.
CLASSES = {
    "upper": r"\p{Lu}",
    "letter": r"\p{L}&&[^\p{Ll}\p{Lu}]",
    "digit": r"\p{N}",
    "stop": r".,;:'\"!?()\-",
    "symbol": r"\p{S}\p{P}&&[^.,;:'\"!?()\-]",
}
#: Names of all classes, in the order of a histogram.
NAMES = ("lower", "space", *CLASSES)
#: Words a text needs for its histograms to count.
LEAST_WORDS = 50
#: Jensen-Shannon distances (square root of the divergence, base 2) up to which a text is near a language.
CHARACTER_LIMIT = 0.2
WORD_LIMIT = 0.28
#: References, of about a kilobyte each, that are sent to the texts at once.
GROUP = 1_024
#: Repeated windows up to which a text is searched for them one by one, without sorting its places.
FEW = 32


def computed(docs: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once per row, however often later expressions use them.

    A plain projection would be merged with those that use it, and its expressions repeated in each place.
    """
    return docs.select("*", F.inline(F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))))


def counted(docs: DataFrame) -> DataFrame:
    """Turns ``text`` into counts: the base columns, ``classes`` (characters per class) and ``common``.

    ``common`` holds the common words of the text, by their place among all common words, with their numbers; words
    count as they are written there, without capitals or stops.
    """
    vocabulary = F.array(*map(F.lit, WORDS))
    text = F.coalesce("text", F.lit(""))
    spaced = text
    for space in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(space), F.lit(" "))
    docs = computed(docs, spaced=spaced, lines=F.filter(F.split(text, "\n"), lambda line: F.trim(_blank(line)) != ""))
    # Splitting at a single blank is far cheaper than at a class of characters; empty parts are rare and go.
    parts = F.split("spaced", " ")
    docs = computed(
        docs,
        words=F.when(F.array_contains(parts, ""), F.filter(parts, lambda word: word != "")).otherwise(parts),
        # Without lower-case letters and white space little is left for the other classes.
        rest=F.regexp_replace("spaced", r"[\p{Ll} ]+", ""),
        spaces=F.length("spaced") - F.length(F.replace("spaced", F.lit(" "), F.lit(""))),
    )
    docs = computed(docs, n_words=F.size("words").cast("long"), triples=_triples())
    # Most texts repeat no window, and most others few: windows are looked at one by one only where that is so.
    docs = computed(docs, ordered=F.when(F.size(F.array_distinct("triples")) < F.size("triples"), F.sort_array("triples")))
    docs = computed(docs, twice=F.array_distinct(F.filter("ordered", lambda h, i: h == F.get("ordered", i - 1))))
    docs = computed(docs, sorted=F.when(F.size("twice") > FEW, F.sort_array(_places())))
    few = F.array_compact(F.transform("triples", lambda h, i: F.when(F.array_contains("twice", h), i)))
    docs = computed(
        docs,
        covered=F.when(F.size("twice") > FEW, F.sort_array(_repeated())).otherwise(F.when(F.size("twice") > 0, few)),
        hits=F.filter("words", lambda word: word.isin(*WORDS)),
    )
    # Each covered window adds its words up to the next covered window, so no word counts twice.
    covers = F.transform(
        "covered", lambda place, i: F.least(F.lit(3), F.coalesce(F.get("covered", i + 1) - place, F.lit(3)))
    )
    lower = F.length("spaced") - F.length("rest") - F.col("spaces")
    others = [F.length("rest") - F.length(F.regexp_replace("rest", f"[{chars}]+", "")) for chars in CLASSES.values()]
    docs = computed(
        docs,
        word_chars=(F.length("spaced") - F.col("spaces")).cast("long"),
        n_symbols=(F.length("rest") - F.length(F.translate("rest", "#*$%&|<>", ""))).cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        n_repeat_words=F.coalesce(F.aggregate(covers, F.lit(0), lambda total, n: total + n), F.lit(0)).cast("long"),
        classes=F.array(*[n.cast("double") for n in (lower, F.col("spaces"), *others)]),
        common=F.transform(
            F.array_distinct("hits"),
            lambda word: F.struct(
                F.array_position(vocabulary, word).cast("int").alias("at"),
                (F.size("hits") - F.size(F.array_remove("hits", word))).cast("double").alias("n"),
            ),
        ),
    )
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes", "common"]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return docs.select("id", "lang", *made, failed.alias("base_failed"))


def _blank(line: Column) -> Column:
    for space in "\t\x0b\x0c\r":
        line = F.replace(line, F.lit(space), F.lit(" "))
    return line


def _triples() -> Column:
    """Windows of three words, as 64-bit hashes."""
    return F.when(
        F.size("words") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _places() -> Column:
    return F.transform("triples", lambda hash, i: F.struct(hash.alias("window"), i.alias("place")))


def _repeated() -> Column:
    """Places of windows found again or before: in sorted order such windows are neighbours."""

    def same(one: Column, i: Column) -> Column:
        return F.coalesce(F.get("sorted", i)["window"] == one["window"], F.lit(False))

    return F.transform(F.filter("sorted", lambda one, i: same(one, i - 1) | same(one, i + 1)), lambda one: one["place"])


class References:
    """The references of all languages, as a written table: lang, classes, words (shares), held (their sum).

    Iterating gives a dictionary per language, in order.
    """

    def __init__(self, table: DataFrame):
        self.table = table
        self.total = table.count()
        self._few = None

    def __len__(self) -> int:
        return self.total

    def __iter__(self) -> Iterator[dict]:
        if self._few is None and self.total <= GROUP:
            self._few = self.table.orderBy("lang").collect()
        for row in self.table.orderBy("lang").toLocalIterator() if self._few is None else self._few:
            yield row.asDict()

    def groups(self) -> Iterator[DataFrame]:
        """About ``GROUP`` languages each, as a single row with an array."""
        count = -(-self.total // GROUP)
        for i in range(count):
            held = self.table.where(F.pmod(F.xxhash64("lang"), F.lit(count)) == i)
            yield held.agg(F.collect_list(F.struct(*self.table.columns)).alias("references"))


def references(counts: DataFrame) -> References:
    """Per language of the counted rows: share of each character class and of each common word.

    Tasks combine to a row per language, class and common word before anything is shuffled. Every language whose texts
    hold a word gets a reference, however many there are.
    """
    entries = F.concat(
        F.array(
            F.struct(F.lit("#words").alias("word"), F.col("n_words").cast("double").alias("n")),
            *[
                F.struct(F.lit(f"#{name}").alias("word"), F.get("classes", F.lit(i)).alias("n"))
                for i, name in enumerate(NAMES)
            ],
        ),
        F.transform("common", lambda one: F.struct(one["at"].cast("string").alias("word"), one["n"].alias("n"))),
    )
    totals = (
        counts.where("lang is not null")
        .select("lang", F.explode(entries).alias("one"))
        .groupBy("lang", F.col("one.word").alias("word"))
        .agg(F.sum("one.n").alias("n"))
    )
    per_lang = totals.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("n"))
    n = F.col("n")
    per_lang = computed(
        per_lang,
        of_classes=F.array(*[n[f"#{name}"] for name in NAMES]),
        of_words=F.array(*[F.coalesce(n[str(i + 1)], F.lit(0.0)) for i in range(len(WORDS))]),
        all_words=n["#words"],
    )
    per_lang = computed(per_lang, all_classes=_sum("of_classes")).where("all_classes > 0 and all_words > 0")
    return References(
        materialize(
            per_lang.select(
                "lang",
                F.transform("of_classes", lambda one: one / F.col("all_classes")).alias("classes"),
                F.transform("of_words", lambda one: one / F.col("all_words")).alias("words"),
                (_sum("of_words") / F.col("all_words")).alias("held"),
            ),
            "references",
        )
    )


def _sum(values: Column | str) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda done, one: done + one)


def _term(p: Column, q: Column) -> Column:
    """A value's part in the Jensen-Shannon divergence, base 2."""
    half = (p + q) / 2
    part = F.when(p > 0, p * F.log2(p / half)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / half)).otherwise(0.0)
    return part / 2


def _character_distance(reference: Column) -> Column:
    return F.sqrt(F.greatest(_sum(F.zip_with("class_shares", reference["classes"], _term)), F.lit(0.0)))


def _word_distance(reference: Column) -> Column:
    """Common words by word, all others as one value. A word the text lacks counts half its share of the reference."""
    pairs = F.transform(
        "word_shares", lambda one: F.struct(one["p"].alias("p"), F.element_at(reference["words"], one["at"]).alias("q"))
    )
    present = F.aggregate(pairs, F.lit(0.0), lambda done, one: done + _term(one["p"], one["q"]) - one["q"] / 2)
    other = _term(F.col("other_share"), F.greatest(F.lit(0.0), 1.0 - reference["held"]))
    return F.sqrt(F.greatest(reference["held"] / 2 + present + other, F.lit(0.0)))


def judge(docs: DataFrame, found: References, least_words: int = LEAST_WORDS) -> DataFrame:
    """Adds lang_near, character_distance, word_distance, near to counted rows.

    The references come to the rows in groups, one after the other; a row carries the nearest so far.
    """
    columns = docs.columns
    if not found:
        return docs.select(
            "*",
            F.lit(None).cast("string").alias("lang_near"),
            F.lit(None).cast("double").alias("character_distance"),
            F.lit(None).cast("double").alias("word_distance"),
            F.lit(True).alias("near"),
        )
    characters = F.greatest(_sum("classes"), F.lit(1.0))
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")

    def distances(reference: Column) -> Column:
        both = F.array(F.struct(_character_distance(reference).alias("characters"), _word_distance(reference).alias("words")))
        made = lambda one: F.struct(
            (one["characters"] / CHARACTER_LIMIT + one["words"] / WORD_LIMIT).alias("sum"),
            reference["lang"].alias("lang"),
            one["characters"].alias("characters"),
            one["words"].alias("words"),
        )
        return F.get(F.transform(both, made), F.lit(0))

    docs = docs.select("*", F.lit(None).cast("struct<sum:double,lang:string,characters:double,words:double>").alias("nearest"))
    for i, group in enumerate(found.groups()):
        if i:  # a plan of all groups would grow with the languages
            docs = materialize(docs, "nearest")
        docs = computed(docs, all_classes=characters, all_words=words)
        docs = computed(
            docs,
            class_shares=F.transform("classes", lambda n: n / F.col("all_classes")),
            word_shares=F.transform("common", lambda one: F.struct(one["at"].alias("at"), (one["n"] / F.col("all_words")).alias("p"))),
            other_share=(F.col("all_words") - F.aggregate("common", F.lit(0.0), lambda done, one: done + one["n"]))
            / F.col("all_words"),
        )
        own = F.when(F.col("n_words") >= least_words, F.array_min(F.transform("references", distances)))
        docs = docs.crossJoin(F.broadcast(group)).select(*columns, F.least("nearest", own).alias("nearest"))
    docs = computed(docs, nearest_one=F.col("nearest"))
    near = (F.col("nearest_one.characters") <= CHARACTER_LIMIT) & (F.col("nearest_one.words") <= WORD_LIMIT)
    return docs.select(
        *columns,
        F.col("nearest_one.lang").alias("lang_near"),
        F.col("nearest_one.characters").alias("character_distance"),
        F.col("nearest_one.words").alias("word_distance"),
        F.coalesce(near, F.lit(True)).alias("near"),
    )


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lang_near, the two
    distances, kept.

    References come from all rows with a language; a document is compared with every one of them and judged by the
    nearest. A text with fewer than ``least_words`` words has no distances and is judged by ``base_failed`` alone. A
    null or empty text has no words and fails. Without any reference, all texts are near. Repeated rows and null ids
    give rows of their own; an empty table gives none. Further columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    counts = materialize(counted(rows), "counts")
    judged = judge(counts, references(counts), least_words)
    return judged.select(
        "id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "lang_near",
        "character_distance",
        "word_distance",
        (~F.col("base_failed") & F.col("near")).alias("kept"),
    )
