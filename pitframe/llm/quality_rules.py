"""Quality rules: counts over the whole text, and how far a document's distributions lie from those of its language.

Two histograms are compared with the language's own, taken over every document of that language in the table:

* character classes: capitals, digits, symbols, blanks, bytes beyond ASCII, the rest;
* common words: the ``common`` most frequent short words of the language, and all other words.

The measure is the Jensen-Shannon distance (base 2, 0 to 1). It says little on short texts, so each comparison has a
minimum length below which it is not made (distance null, rule passed).

No text is shuffled: the first pass sends partial counts per language and short word, the second joins one row per
language, which Spark broadcasts when its written size allows and splits by AQE otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pitframe.llm.common import BLANKS, split_words, whole
from pitframe.sources.tables import materialise

# The characters counted as symbols, and the blanks.
SYMBOLS = "#*$%&|<>"
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rules:
    min_words: int = 50  # fewer fail the base rule
    max_repeat_percent: int = 50  # a larger share of words in repeated windows fails it
    common: int = 20  # words of the common-word histogram
    short: int = 4  # longest common word, in code points
    min_characters: int = 200  # for the character classes
    min_compared_words: int = 100  # for the common words
    max_character_distance: float = 0.26
    max_word_distance: float = 0.31


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def character_classes(text: Column) -> dict[str, Column]:
    """Counts by class; together the length in code points plus the bytes beyond one per character."""
    length = F.length(text)
    upper = F.regexp_count(text, F.lit("[A-Z]"))
    digit = F.regexp_count(text, F.lit("[0-9]"))
    symbol = F.regexp_count(text, F.lit("[#*$%&|<>]"))
    blank = F.regexp_count(text, F.lit(BLANKS))
    return {"n_upper": upper, "n_digits": digit, "n_symbols": symbol, "n_blanks": blank, "n_wide": F.octet_length(text) - length, "length": length}


def _classes_array() -> Column:
    rest = F.col("length") - F.col("n_upper") - F.col("n_digits") - F.col("n_symbols") - F.col("n_blanks")
    return F.array(*[F.col(c).cast("long") for c in ("n_upper", "n_digits", "n_symbols", "n_blanks", "n_wide")], rest.cast("long"))


def references(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per language: ref_characters, ref_words (the words), ref_counts (their counts, then all others)."""
    worded = docs.select("lang", whole(F.col("text")).alias("t")).withColumn("w", split_words(F.col("t"), BLANKS))
    sums = (worded.select("lang", F.size("w").alias("n"), *[c.alias(n) for n, c in character_classes(F.col("t")).items()])
            .select("lang", "n", _classes_array().alias("c"))
            .groupBy("lang").agg(F.sum("n").alias("total"), F.array(*[F.sum(F.get("c", F.lit(i))) for i in range(6)]).alias("ref_characters")))
    letters = "^\\p{L}{1," + str(rules.short) + "}$"
    counts = (worded.select("lang", F.explode("w").alias("word"))
              .where((F.length("word") <= rules.short) & F.col("word").rlike(letters))
              .groupBy("lang", "word").count())
    # a bounded vocabulary: words of at most four letters
    ranked = (counts.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("count"), "word")))
              .where(F.col("rank") <= rules.common))
    common = (ranked.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "word", "count"))).alias("top"))
              .select("lang", F.col("top.word").alias("ref_words"), F.col("top.count").alias("ref_counts")))
    none = F.array().cast("array<string>"), F.array().cast("array<bigint>")
    other = F.aggregate("ref_counts", F.col("total"), lambda left, n: left - n)
    return (sums.alias("s").join(common.alias("c"), F.col("s.lang").eqNullSafe(F.col("c.lang")), "left")
            .select(F.col("s.lang").alias("ref_lang"), "total", "ref_characters", F.coalesce("ref_words", none[0]).alias("ref_words"),
                    F.coalesce("ref_counts", none[1]).alias("ref_counts"))
            .select("ref_lang", "ref_characters", "ref_words", F.concat("ref_counts", F.array(other)).alias("ref_counts")))


def _distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two histograms, to 4 decimals."""
    total_p, total_q = (F.aggregate(F.col(c), F.lit(0).cast("long"), lambda a, x: a + x) for c in (p, q))
    shares = F.zip_with(F.transform(F.col(p), lambda x: x.cast("double")), F.transform(F.col(q), lambda x: x.cast("double")),
                        lambda x, y: F.struct(x.alias("p"), y.alias("q")))

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    def both(a: Column, s: Column, np: Column, nq: Column) -> Column:
        x, y = s["p"] / np, s["q"] / nq
        return a + part(x, y) + part(y, x)

    return F.aggregate(
        F.array(F.struct(shares.alias("s"), total_p.alias("np"), total_q.alias("nq"))), F.lit(None).cast("double"),
        lambda _, z: F.round(F.sqrt(F.greatest(F.lit(0.0), F.aggregate(z["s"], F.lit(0.0), lambda a, s: both(a, s, z["np"], z["nq"])) / 2)), 4))


def measure(docs: DataFrame, refs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` with the base counts, the two distances, base_failed and kept; every row is judged by itself."""
    parsed = (docs.select("*", whole(F.col("text")).alias("_t")).withColumn("_w", split_words(F.col("_t"), BLANKS))
              .withColumns(character_classes(F.col("_t"))))
    lines = F.filter(F.split("_t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.when(F.size("_w") >= 3, F.transform(F.sequence(F.lit(0), F.size("_w") - 3),
                     lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    parsed = parsed.withColumns({"_lines": lines, "_windows": windows})
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    parsed = parsed.withColumn("_sorted", F.when(repeated, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter("_sorted", lambda x, k: (x["h"] == F.get("_sorted", k - 1)["h"]) | (x["h"] == F.get("_sorted", k + 1)["h"]))
    starts = F.array_sort(F.transform(again, lambda x: x["i"]))
    covered = F.aggregate(starts, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
                          lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n")), lambda a: a["n"])
    spaced = F.concat(F.lit(" "), F.array_join("_w", "  "), F.lit(" "))
    counted = parsed.select(
        *docs.columns, F.size("_w").cast("long").alias("n_words"), (F.col("length") - F.col("n_blanks")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"), (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), _classes_array().alias("_classes"), F.col("length").alias("_length"),
        spaced.alias("_spaced"))
    joined = counted.join(refs, counted["lang"].eqNullSafe(refs["ref_lang"]), "left")
    hits = F.transform("ref_words", lambda w: ((F.octet_length("_spaced") - F.octet_length(F.replace(F.col("_spaced"), F.concat(F.lit(" "), w, F.lit(" ")), F.lit(""))))
                                               / (F.octet_length(w) + 2)).cast("long"))
    joined = joined.withColumn("_hits", hits)
    joined = joined.withColumn("_words", F.concat("_hits", F.array(F.aggregate("_hits", F.col("n_words"), lambda left, n: left - n))))
    judged = joined.select(
        *docs.columns, F.monotonically_increasing_id().alias("_order"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.when(F.col("_length") >= rules.min_characters, _distance("_classes", "ref_characters")).alias("character_distance"),
        F.when(F.col("n_words") >= rules.min_compared_words, _distance("_words", "ref_counts")).alias("word_distance"))
    base_failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    near = ((F.coalesce("character_distance", F.lit(0.0)) <= rules.max_character_distance)
            & (F.coalesce("word_distance", F.lit(0.0)) <= rules.max_word_distance))
    return judged.withColumn("base_failed", base_failed).withColumn("kept", ~F.col("base_failed") & near)


#: Columns that ``measure`` adds.
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "character_distance", "word_distance", "base_failed", "kept")


def quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per input row: doc_id, the counts and distances, base_failed, kept.

    A null text counts as empty (no words, so it fails the base rule); a null language is a language of its own; repeated
    rows are judged one by one; an empty table gives an empty result. Other columns are not read.
    """
    docs = docs.select("doc_id", "text", "lang")
    refs = materialise(references(docs, rules), "language-references")
    return measure(docs, refs, rules).select("doc_id", *ADDED)


def keep(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns, whatever these are called."""
    refs = materialise(references(docs.select("text", "lang"), rules), "language-references")
    carried = docs.select(F.struct("*").alias("_row"), F.col("text"), F.col("lang"))
    # The row number keeps the filter above the step that measures: without it the optimizer copies the expressions into a filter on
    # the scan, where each window of a text would be compared with a list that is sorted anew every time.
    return measure(carried, refs, rules).where("kept AND _order >= 0").select("_row.*")


def oracle(rules: Rules = Rules()) -> str:
    blank = r"[\x20\x09-\x0D]"
    js = """round(sqrt(greatest(0.0, list_sum(list_transform(range(1, len({p}) + 1), lambda k:
      CASE WHEN {p}[k] > 0 THEN ({p}[k] / list_sum({p})::DOUBLE) * log2(2 * ({p}[k] / list_sum({p})::DOUBLE) / ({p}[k] / list_sum({p})::DOUBLE + {q}[k] / list_sum({q})::DOUBLE)) ELSE 0.0 END
      + CASE WHEN {q}[k] > 0 THEN ({q}[k] / list_sum({q})::DOUBLE) * log2(2 * ({q}[k] / list_sum({q})::DOUBLE) / ({p}[k] / list_sum({p})::DOUBLE + {q}[k] / list_sum({q})::DOUBLE)) ELSE 0.0 END)) / 2)), 4)"""
    return f"""WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
  w AS (SELECT doc_id, lang, t, list_filter(regexp_split_to_array(t, '{blank}+'), lambda x: x <> '') AS w FROM d),
  c AS (SELECT *, length(t) AS n, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS up, length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS dg,
      length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS sy, length(t) - length(regexp_replace(t, '{blank}', '', 'g')) AS bl FROM w),
  h AS (SELECT *, [up, dg, sy, bl, strlen(t) - n, n - up - dg - sy - bl] AS cls FROM c),
  lang_sums AS (SELECT lang, sum(len(w)) AS total, [sum(cls[1]), sum(cls[2]), sum(cls[3]), sum(cls[4]), sum(cls[5]), sum(cls[6])] AS ref_c FROM h GROUP BY lang),
  words AS (SELECT doc_id, lang, unnest(w) AS word, unnest(range(len(w))) AS i FROM w),
  common AS (SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r FROM
      (SELECT lang, word, count(*) AS n FROM words WHERE regexp_full_match(word, '\\p{{L}}{{1,{rules.short}}}') GROUP BY lang, word)),
  refs AS (SELECT lang, list(word ORDER BY r) AS rw, list(n ORDER BY r) AS rn FROM common WHERE r <= {rules.common} GROUP BY lang),
  ref AS (SELECT s.lang, ref_c, rw, list_append(rn, total - list_sum(rn)) AS ref_w FROM lang_sums s LEFT JOIN refs r ON s.lang IS NOT DISTINCT FROM r.lang),
  grams AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS g FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
  again AS (SELECT doc_id, i FROM (SELECT doc_id, i, g, count(*) OVER (PARTITION BY doc_id, g) AS k FROM grams WHERE g IS NOT NULL) WHERE k > 1),
  covered AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat FROM again, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
  lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
  hits AS (SELECT h.doc_id, list(coalesce(k.n, 0) ORDER BY c.r) AS hw FROM h JOIN common c ON h.lang IS NOT DISTINCT FROM c.lang AND c.r <= {rules.common}
      LEFT JOIN (SELECT doc_id, word, count(*) AS n FROM words GROUP BY doc_id, word) k ON k.doc_id = h.doc_id AND k.word = c.word GROUP BY h.doc_id),
  m AS (SELECT h.doc_id, len(w) AS n_words, n - bl AS word_chars, sy AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
      CASE WHEN n >= {rules.min_characters} THEN {js.format(p="cls", q="ref_c")} END AS character_distance,
      CASE WHEN len(w) >= {rules.min_compared_words} THEN {js.format(p="list_append(hw, len(w) - list_sum(hw))", q="ref_w")} END AS word_distance
    FROM h LEFT JOIN ref ON h.lang IS NOT DISTINCT FROM ref.lang LEFT JOIN hits USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
  b AS (SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, character_distance, word_distance, base_failed,
  NOT base_failed AND coalesce(character_distance, 0) <= {rules.max_character_distance} AND coalesce(word_distance, 0) <= {rules.max_word_distance} AS kept FROM b"""
