"""Quality rules by distribution divergence (operator 1), in DataFrame functions only.

Every document gets counts (words, characters in words, symbols, repeated lines,
words in repeated windows) and two histograms: character classes of the text and
common words of its language. The reference of a language is the mean of the
normalised histograms of its documents that pass the base rule and are long
enough. A document fails if its Jensen-Shannon distance to its language's
reference is too large, where it is long enough for the distance to mean
something (the guards). A language with fewer than MIN_REFERENCE such documents
is compared with the mean over all languages, and by character classes alone.

Edge cases: a null text is an empty text (no words: it fails the base rule); a
null language is a language of its own; a language without a word list has a
one-bin word histogram, whose distance is 0; without any document for a
reference all distances are 0; repeated rows are judged alike; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.llm._shared import SPACE, Scratch, prefix, text_of, without

# Frequent function words of each language.
COMMON = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "was", "for", "on", "are", "with", "as", "this", "by", "be", "from", "or"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una", "su", "al", "es"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur", "au", "pas", "plus"],
}
#: Character classes, each counted in what the earlier ones leave; the last bin is the rest.
SYMBOLS = r"[#*$%&|<>]+"
CLASSES = ["[a-z]+", "[A-Z]+", f"[{SPACE}]+", r"[^\x00-\x7F]+", "[0-9]+", SYMBOLS, r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"]
WINDOW = 8
#: Guards and limits of the verdict.
MIN_CHARS, MIN_WORDS = 300, 60
#: Documents that make a language's own reference.
MIN_REFERENCE = 30
#: A limit is a constant plus a multiple of the distance that sampling alone gives, 1 / sqrt(length).
CLASS_LIMIT, WORD_LIMIT = (0.16, 3.0), (0.24, 1.2)
#: Languages whose references may be broadcast; with more, the join is left to Spark.
BROADCAST_LANGUAGES = 4096


def let(value: Column, body) -> Column:
    """body(v) with v bound to value, which is computed once a row."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def words_of(text: Column) -> Column:
    """The words of a text. One blank is left between words: a split at one plain character is the fast one."""
    held = F.btrim(F.regexp_replace(text, "[\\x09-\\x0D]+|\\x20{2,}", " "), F.lit(" "))
    held = F.when(held.contains("  "), F.regexp_replace(held, "\\x20{2,}", " ")).otherwise(held)
    return F.when(held == "", F.array().cast("array<string>")).otherwise(F.split(held, " "))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words in windows that occur twice or more; windows are compared by 64-bit hashes of word hashes."""
    zero = F.lit(0).cast("long")

    def of_windows(hashes: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            same = lambda i, j: F.get(s, i)["h"] == F.get(s, j)["h"]
            twice = F.filter(s, lambda x, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
            return let(F.array_sort(F.transform(twice, lambda x: x["p"])), covered)

        def covered(at: Column) -> Column:
            gaps = F.transform(at, lambda x, i: F.when(i == 0, F.lit(window)).otherwise(F.least(F.lit(window), x - F.get(at, i - 1))))
            return F.aggregate(gaps, zero, lambda a, x: a + x)

        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, let(F.array_sort(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), of_sorted)).otherwise(zero)

    def of_hashes(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - window)
        return let(F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])), of_windows)

    return F.when(F.size(words) > window, let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)).otherwise(zero)


def with_class_counts(docs: DataFrame, p: str) -> DataFrame:
    """docs with {p}counts, the characters of {p}text in each class.

    Every step is a projection of its own and works on what the step before has
    left: a column that is used twice is not inlined, so each is made once.
    """
    left = docs.withColumn(f"{p}left0", F.col(f"{p}text"))
    for i, pattern in enumerate(CLASSES):
        left = left.withColumn(f"{p}left{i + 1}", F.regexp_replace(F.col(f"{p}left{i}"), pattern, ""))
        left = left.withColumn(f"{p}n{i}", (F.length(f"{p}left{i}") - F.length(f"{p}left{i + 1}")).cast("double"))
        left = left.drop(f"{p}left{i}")
    rest = F.length(f"{p}left{len(CLASSES)}").cast("double")
    n = [f"{p}n{i}" for i in range(len(CLASSES))]
    return left.withColumn(f"{p}counts", F.array(*n, rest)).drop(*n, f"{p}left{len(CLASSES)}")


def word_counts(text: Column, n_words: Column, lang: Column) -> Column:
    """How often each common word of the language stands between blanks or marks, then the number of other words."""
    n = n_words.cast("double")

    def count(held: Column, word: str) -> Column:
        return F.size(F.filter(held, lambda x: x == word)).cast("double")

    def with_rest(c: Column) -> Column:
        return F.concat(c, F.array(F.greatest(F.lit(0.0), n - F.aggregate(c, F.lit(0.0), lambda a, x: a + x))))

    def of_language(own: list[str]) -> Column:
        pattern = f"(?i)(?<![^{SPACE}(\"'])(?:{'|'.join(own)})(?![^{SPACE}.,;:!?\"')])"
        found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda w: F.lower(w))
        return let(let(found, lambda held: F.array(*[count(held, w) for w in own])), with_rest)

    out = F.array(n)
    for name, own in COMMON.items():
        out = F.when(lang == name, of_language(own)).otherwise(out)
    return out


def normalised(counts: Column) -> Column:
    """Shares of the total; all zero where the total is zero."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return let(counts, lambda c: let(total(c), lambda t: F.transform(c, lambda x: F.when(t > 0, x / t).otherwise(F.lit(0.0)))))


def js_distance(p: Column, q: Column) -> Column:
    """The square root of the Jensen-Shannon divergence with base 2: from 0 to 1."""
    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2))


def measured(docs: DataFrame, p: str) -> DataFrame:
    """docs with the five counts and base_failed, and under prefix p lang, chars, classes and common, which the verdict needs."""
    lang = docs["lang"].cast("string") if "lang" in [c.lower() for c in docs.columns] else F.lit(None).cast("string")
    text, words, counts = (F.col(f"{p}{x}") for x in ("text", "words", "counts"))
    held = docs.withColumns({f"{p}text": text_of(docs), f"{p}lang": F.coalesce(lang, F.lit(""))})
    held = held.withColumns({f"{p}words": words_of(text), f"{p}chars": F.length(f"{p}text")}).withColumn("n_words", F.size(words).cast("long"))
    held = with_class_counts(held, p)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    held = held.withColumns({
        "word_chars": (F.col(f"{p}chars") - F.get(counts, F.lit(CLASSES.index(f"[{SPACE}]+")))).cast("long"),
        "n_symbols": F.get(counts, F.lit(CLASSES.index(SYMBOLS))).cast("long"),
        "n_dup_lines": let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "n_repeat_words": repeated_words(words).cast("long"),
        f"{p}classes": normalised(counts),
        f"{p}common": normalised(word_counts(text, F.col("n_words"), F.col(f"{p}lang"))),
    }).drop(f"{p}text", f"{p}words", f"{p}counts")
    return held.withColumn("base_failed", (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30))


def references(made: DataFrame, p: str) -> DataFrame:
    """(lang, n, ref_classes, ref_common): means over the measured documents of MIN_CHARS or more that pass the base rule.

    Documents are reduced to sums of each language before the shuffle.
    """
    widest = 1 + max(map(len, COMMON.values()))
    mean = lambda c, n: F.array(*[F.avg(F.coalesce(F.get(F.col(c), F.lit(i)), F.lit(0.0))) for i in range(n)])
    held = made.where((F.col(f"{p}chars") >= MIN_CHARS) & ~F.col("base_failed"))
    return held.groupBy(F.col(f"{p}lang").alias("lang")).agg(F.count(F.lit(1)).alias("n"), mean(f"{p}classes", len(CLASSES) + 1).alias("ref_classes"), mean(f"{p}common", widest).alias("ref_common"))


def pooled_classes(refs: DataFrame) -> Column:
    """The mean character classes over all languages: as many numbers as there are classes."""
    total = F.sum("n")
    row = refs.agg(*[(F.sum(F.col("n") * F.get("ref_classes", F.lit(i))) / total).alias(f"c{i}") for i in range(len(CLASSES) + 1)]).first()
    return F.array(*[F.lit(x) for x in row]) if row[0] is not None else F.lit(None).cast("array<double>")


def judge(made: DataFrame, refs: DataFrame, pooled: Column, p: str) -> DataFrame:
    """Measured documents with the two distances and kept."""
    col = lambda x: F.col(f"{p}{x}")
    own = F.col("n") >= MIN_REFERENCE
    refs = refs.where(own).select(*[F.col(a).alias(f"{p}{b}") for a, b in (("lang", "ref_lang"), ("ref_classes", "ref_classes"), ("ref_common", "ref_common"))])
    joined = made.join(refs, made[f"{p}lang"] == refs[f"{p}ref_lang"], "left")
    distance = lambda long, d: F.when(long, F.coalesce(d, F.lit(0.0))).otherwise(F.lit(0.0))
    judged = joined.withColumns({
        "class_distance": distance(col("chars") >= MIN_CHARS, js_distance(col("classes"), F.coalesce(col("ref_classes"), pooled))),
        "word_distance": distance(F.col("n_words") >= MIN_WORDS, js_distance(col("common"), F.slice(col("ref_common"), F.lit(1), F.size(col("common"))))),
    })
    limit = lambda by, n: F.lit(by[0]) + F.lit(by[1]) / F.sqrt(F.greatest(F.lit(1), n))
    near = (F.col("class_distance") <= limit(CLASS_LIMIT, col("chars"))) & (F.col("word_distance") <= limit(WORD_LIMIT, F.col("n_words")))
    kept = ~F.col("base_failed") & near
    return judged.withColumn("kept", kept).select(*[c for c in made.columns if not c.startswith(p)], "class_distance", "word_distance", "kept")


MADE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept")


def quality_rules(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """docs judged against the references of their own corpus.

    Measurements are written, with the text if the result is to have it, since
    references and verdicts both need all of them. The references are one row a
    language; they are written once, counted, and broadcast if they are few.
    """
    docs = without(docs, MADE)
    p = prefix(docs.columns)
    scratch = Scratch(docs.sparkSession, "quality")
    made = measured(docs, p)
    made = scratch.save(made if keep_text else without(made, ["text"]))
    refs = scratch.save(references(made, p))
    return judge(made, F.broadcast(refs) if refs.count() <= BROADCAST_LANGUAGES else refs, pooled_classes(refs), p)
