"""Quality rules by distribution divergence, in DataFrame functions only.

Method. Two histograms describe a document: its characters by class, and its words by the commonest
words of its language (all others being one class). They are compared with the histograms of all
documents of the language by Jensen-Shannon distance (base 2, 0 to 1); a document that is too far
from either is rejected. A histogram of a short text says little, so each comparison has a least
length, below which it passes. Before that, two base rules reject texts of too few words and texts
that mostly repeat their own three-word windows.

References are summed over the documents that pass the base rules, per listed language, and then
once more over the nearer half of them; documents of other or no language are compared by character
class with the reference of all. The five rows of references are all that is broadcast.

Per document everything is array functions on its own row, so nothing but the small table of
features is written and only sums per language are shuffled.

Null, empty and wordless texts have no words and fail the base rule. Rows without a doc_id and
repeated rows are judged like any other. Columns other than doc_id, text and lang are not read. No
rows in, no rows out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import kept_beyond, private_tables, ready, stored

# Very common words of the languages whose references are kept.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "en": "the of and to in is that for it was on with as be by this are from at or",
    "es": "de la que el en y a los se del las un por con no una su para es al",
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas au avec",
}
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
# disjoint classes; what is in none of them is mostly lower-case letters
CLASSES = [r"\p{Lu}", r"\p{Nd}", SYMBOLS, r"[\p{P}&&[^#*%&]]"]
_ANY = "*"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def _is_one_of(names: str):
    return lambda word: word.isin(names.split())


def features(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Counts of each document: base counts, character classes and common words; and its row, if
    that is to be carried along."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if carry else F.lit(None).cast("int")
    text = F.coalesce(F.col("text"), F.lit(""))
    spaces = F.regexp_count(text, F.lit(SPACE))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("lang").isin(sorted(COMMON_WORDS)), F.col("lang")).otherwise(_ANY).alias("lang"),
        F.col("text").cast("string").alias("text"), row.alias("row")).select(
        "doc_id", "lang", "row", words_of(F.col("text")).alias("words"),
        (F.length(text) - spaces).cast("long").alias("word_chars"), spaces.alias("spaces"),
        F.array(*[F.regexp_count(text, F.lit(c)) for c in CLASSES]).alias("classes"),
        lines.alias("lines"))
    listed = F.lit(None).cast("array<string>")
    for lang, names in sorted(COMMON_WORDS.items()):
        listed = F.when(F.col("lang") == lang, F.array(*map(F.lit, names.split()))).otherwise(listed)
    found = F.lit(None).cast("array<string>")
    for lang, names in sorted(COMMON_WORDS.items()):
        found = F.when(F.col("lang") == lang, F.filter("words", _is_one_of(names))).otherwise(found)
    n = F.size("words")
    second = first.select(
        "doc_id", "lang", "row", n.cast("long").alias("n_words"), "word_chars",
        F.col("classes")[2].cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.concat(F.col("classes"), F.array(
            "spaces", (F.col("word_chars") - F.aggregate("classes", F.lit(0), lambda a, x: a + x)).cast("int")
        )).alias("chars"),
        listed.alias("listed"), found.alias("found"),
        F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
            F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
        .otherwise(F.array().cast("array<bigint>")).alias("windows"))
    pairs = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    third = second.withColumn(
        "pairs", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), pairs)).drop("windows")
    again = F.sort_array(F.transform(
        F.filter("pairs", lambda x, k: (x["h"] == F.get("pairs", k - 1)["h"])
                 | (x["h"] == F.get("pairs", k + 1)["h"])), lambda x: x["i"]))
    fourth = third.withColumn("again", again).drop("pairs")
    covered = F.aggregate(
        "again", F.struct(F.lit(0).alias("total"), F.lit(-3).alias("last")),
        lambda a, x: F.struct((a["total"] + F.least(F.lit(3), x - a["last"])).alias("total"),
                              x.alias("last")), lambda a: a["total"])
    counts = F.transform("listed", lambda w: F.size(F.filter("found", lambda x: x == w)))
    return fourth.select(
        "doc_id", "lang", *(["row"] if carry else []), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "chars",
        F.concat(counts, F.array((F.col("n_words") - F.size("found")).cast("int"))).alias("common"))


def distance(one: Column, other: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts; null if one is empty or null."""
    total = lambda h: F.aggregate(h, F.lit(0.0), lambda a, x: a + x)
    # the total is a lambda's variable, so that it is summed up once and not for every bar
    share = lambda h: F.flatten(F.transform(F.array(total(h)), lambda t: F.transform(
        h, lambda x: x / F.nullif(t, F.lit(0.0)))))
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    terms = F.zip_with(share(one), share(other), lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    found = F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))
    return F.when((total(one) > 0) & (total(other) > 0), found)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _doubles(name: str) -> Column:
    return F.transform(name, lambda x: x.cast("double"))


def medians(values: DataFrame, bins: int = 1 << 16) -> DataFrame:
    """values(ref, kind, value between 0 and 1) → (ref, kind, middle), the exact lower median.

    Bins are counted first, and values only in the bin that holds the median, so what a group brings
    together is a row per bin, then one per distinct value of one bin.
    """
    key = ["ref", "kind"]
    binned = values.where("value is not null").withColumn("bin", F.floor(F.col("value") * bins))
    up_to = lambda by: Window.partitionBy(*key).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    counts = (binned.groupBy(*key, "bin").agg(F.count("*").alias("n"))
              .withColumn("upto", F.sum("n").over(up_to("bin")))
              .withColumn("rank", F.ceil(F.sum("n").over(Window.partitionBy(*key)) / 2)))
    held = (counts.where("upto >= rank and upto - n < rank")
            .select(*key, "bin", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank")))
    inner = (binned.join(F.broadcast(held), [*key, "bin"]).groupBy(*key, "rank", "value")
             .agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(up_to("value"))))
    return inner.where("upto >= rank and upto - n < rank").select(*key, F.col("value").alias("middle"))


def references(found: DataFrame, least_words: int = 1000) -> DataFrame:
    """Summed histograms of the documents that pass the base rules: one row per listed language and
    one of all; without those of fewer than `least_words` words.

    Sums of everything are taken first, and those that count over the half of the documents that is
    nearest to them, so that even a third of odd documents leaves no mark.
    """
    good = (found.where(~base_failed())
            .withColumn("ref", F.explode(F.array_distinct(F.array("lang", F.lit(_ANY)))))
            .withColumn("common", F.when(F.col("ref") != _ANY, F.col("common"))))
    classes, common = len(CLASSES) + 2, len(next(iter(COMMON_WORDS.values())).split()) + 1

    def sums(rows: DataFrame, chars: Column, words: Column) -> DataFrame:
        return rows.groupBy("ref").agg(
            F.array(*[F.sum(F.when(chars, F.col("chars")[i].cast("double"))) for i in range(classes)])
            .alias("all_chars"),
            F.array(*[F.sum(F.when(words, F.get("common", F.lit(i)).cast("double"))) for i in range(common)])
            .alias("all_common"), F.sum("n_words").alias("all_words"))

    first = sums(good, F.lit(True), F.lit(True))
    near = (good.join(F.broadcast(first), "ref")
            .withColumn("dc", distance(_doubles("chars"), F.col("all_chars")))
            .withColumn("dw", distance(_doubles("common"), F.col("all_common")))
            .select("ref", "chars", "common", "n_words", "dc", "dw"))
    near = stored(near, "rule-distances")  # read for the bins, the values and the sums
    values = near.select("ref", F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value"))
                                                    for c in ("dc", "dw")])).alias("x")).select("ref", "x.*")
    middle = medians(values).groupBy("ref").agg(*[F.max(F.when(F.col("kind") == d, F.col("middle"))).alias(m)
                                                  for d, m in (("dc", "mc"), ("dw", "mw"))])
    core = near.join(F.broadcast(middle), "ref", "left")
    return (sums(core, F.col("dc") <= F.col("mc"), F.col("dw") <= F.col("mw"))
            .where(F.col("all_words") >= least_words).withColumnRenamed("ref", "lang"))


def judged(found: DataFrame, known: DataFrame, least_chars: int = 200, least_words: int = 100,
           most_class_distance: float = 0.18, most_word_distance: float = 0.3) -> DataFrame:
    """Features with base_failed, the two distances (null where not compared) and kept."""
    verdict = ((F.coalesce("class_distance", F.lit(0.0)) <= most_class_distance)
               & (F.coalesce("word_distance", F.lit(0.0)) <= most_word_distance))
    return (found.join(F.broadcast(known), "lang", "left")
            .withColumn("base_failed", base_failed())
            .withColumn("class_distance", F.when(F.col("word_chars") >= least_chars,
                                                 distance(_doubles("chars"), F.col("all_chars"))))
            .withColumn("word_distance", F.when(
                (F.col("n_words") >= least_words) & (F.col("lang") != _ANY),
                distance(_doubles("common"), F.col("all_common"))))
            .withColumn("kept", ~F.col("base_failed") & verdict))


def _known(found: DataFrame) -> DataFrame:
    """The stored references, without the tables it took to find them."""
    with private_tables(found.sparkSession):
        return kept_beyond(references(found), "rule-references")


def quality_rules(docs: DataFrame, **limits: float) -> DataFrame:
    """docs(doc_id, text, lang) → (doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, class_distance, word_distance), one row per input row.

    `limits` are those of `judged`.
    """
    ready(docs.sparkSession)
    found = stored(features(docs), "rule-features")
    return judged(found, _known(found), **limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "class_distance", "word_distance")


def passing(docs: DataFrame, **limits: float) -> DataFrame:
    """The rows of docs that the rules keep, all columns as they are. Rows are stored beside their
    features, rather than shuffled to meet their verdicts; the references read the features alone."""
    ready(docs.sparkSession)
    found = stored(features(docs, carry=True), "rule-features")
    return judged(found, _known(found), **limits).where("kept").select("row.*")
