"""Operator 2, quality rules: distribution divergence, with DataFrame functions only.

A document's histogram of character classes and of common words is compared with its language's reference by
Jensen-Shannon distance. The references are sums over all documents that pass the base rules and the length guards, so
they come from the whole corpus; what is broadcast has one row per known language.

The measures of every document are written once as a table (without its text unless asked for), so the texts are
read and cut into words once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duotower.llm.common import written
from duotower.session import ship_package

# Frequent function words of each language.
COMMON_WORDS = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"),
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "au"),
}
N_COMMON = 16
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50      # base rules
GUARD_CHARS, GUARD_WORDS = 400, 100         # shorter texts are not judged by their characters, or by their words
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.32, 0.28
_BLANK = r"[\x20\x09-\x0D]"
# Character classes, each counted in what the ones before leave: a-z, blanks, A-Z, digits, sentence marks, other ASCII,
# other letters; what remains is the last class.
_CLASSES = ("[a-z]+", _BLANK + "+", "[A-Z]+", "[0-9]+", r"[.,;:!?'\"()\-]+", r"[\x00-\x7F]+", r"\p{L}+")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where lambda functions refer to it."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Runs of other characters than blank, tab and line ends."""
    return F.array_remove(F.split(text, _BLANK + "+"), "")


def repeated_words(ws: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""
    grams = F.transform(F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.struct(F.xxhash64(ws[i], ws[i + 1], ws[i + 2]).alias("h"), i.alias("i")))

    def places(s: Column) -> Column:
        # sorted by window, so equal windows are neighbours
        n = F.size(s)
        twice = F.filter(F.transform(s, lambda g, k: F.struct(
            g["i"].alias("i"), (((k > 0) & (g["h"] == F.get(s, k - 1)["h"])) | ((k < n - 1) & (g["h"] == F.get(s, k + 1)["h"]))).alias("twice"))),
            lambda g: g["twice"])
        return F.array_sort(F.transform(twice, lambda g: g["i"]))

    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(let(F.array_sort(grams), places), start,
                          lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")), lambda acc: acc["n"])
    return F.when(F.size(ws) >= 3, covered).otherwise(F.lit(0).cast("long"))


def measures(docs: DataFrame, text_col: str, lang_col: str, prefix: str) -> DataFrame:
    """``docs`` plus the base measures and histograms, all names starting with ``prefix``."""
    p = prefix
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lang = F.col(f"`{lang_col}`")
    out = docs.withColumn(f"{p}words", words(text)).withColumn(f"{p}rest0", text)
    ws = F.col(f"{p}words")
    # each rest feeds the next class: computed once, by one projection after the other
    for k, pattern in enumerate(_CLASSES):
        out = out.withColumn(f"{p}rest{k + 1}", F.regexp_replace(F.col(f"{p}rest{k}"), pattern, ""))
    left = [F.char_length(f"{p}rest{k}").cast("long") for k in range(len(_CLASSES) + 1)]
    # every word stands between two blanks of its own, so counting never overlaps
    out = out.withColumn(f"{p}padded", F.concat(F.lit(" "), F.lower(F.array_join(ws, "  ")), F.lit(" ")))
    padded = F.col(f"{p}padded")
    hits = []
    for k in range(N_COMMON):
        word = F.lit(None).cast("string")
        for name, common in COMMON_WORDS.items():
            word = F.when(lang == name, F.lit(f" {common[k]} ")).otherwise(word)
        gone = F.octet_length(padded) - F.octet_length(F.replace(padded, word, F.lit("")))
        hits.append(F.coalesce((gone / F.octet_length(word)).cast("long"), F.lit(0).cast("long")))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size(ws).cast("long").alias(f"{p}n_words"),
        (F.char_length(F.array_join(ws, ""))).cast("long").alias(f"{p}word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias(f"{p}n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias(f"{p}n_dup_lines"),
        repeated_words(ws).alias(f"{p}n_repeat_words"),
        F.array(*[a - b for a, b in zip(left, left[1:])], left[-1]).alias(f"{p}classes"),
        F.array(*hits).alias(f"{p}common"),
    )


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms given as arrays of counts; null if one is empty."""
    def share(h):
        return let(F.aggregate(h, F.lit(0.0), lambda a, x: a + x), lambda n: F.transform(h, lambda x: x / F.nullif(n, F.lit(0.0))))

    def part(a, m):
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    terms = F.zip_with(share(counts), share(reference), lambda a, b: part(a, (a + b) / 2) / 2 + part(b, (a + b) / 2) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)))


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", drop_text: bool = False, prefix: str = "q_",
          max_char_distance: float = MAX_CHAR_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance,
    kept, each name with ``prefix`` (lengthened by underscores until no column of ``docs`` starts with it).

    ``base_failed``: under 50 words, or more than half of the words in repeated three-word windows. ``kept``: not
    base_failed and, where the guards are met and the language is known, both distances within their limits.

    Defined results: null and empty texts have no words and fail the base rules; a null or unknown language has no
    common words and is judged by base rules alone; repeated rows are judged each; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    p = prefix
    lang = F.col(f"`{lang_col}`")
    m = measures(docs, text_col, lang_col, p)
    m = m.withColumn(f"{p}base_failed", (F.col(f"{p}n_words") < MIN_WORDS)
                     | (100 * F.col(f"{p}n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{p}n_words")))
    # the histogram of common words has one more bin for all other words
    seen = F.aggregate(f"{p}common", F.lit(0).cast("long"), lambda a, x: a + x)
    m = m.withColumn(f"{p}common", F.concat(f"{p}common", F.array(F.col(f"{p}n_words") - seen)))
    chars = F.aggregate(f"{p}classes", F.lit(0).cast("long"), lambda a, x: a + x)
    healthy = ~F.col(f"{p}base_failed") & F.coalesce(lang.isin(*COMMON_WORDS), F.lit(False))
    m = m.withColumn(f"{p}by_chars", healthy & (chars >= GUARD_CHARS)).withColumn(f"{p}by_words", healthy & (F.col(f"{p}n_words") >= GUARD_WORDS))
    m = written(m.drop(text_col) if drop_text else m, "quality")
    # one row per known language
    def total(col, n, judged):
        return F.array(*[F.coalesce(F.sum(F.when(F.col(judged), F.col(col)[k])), F.lit(0)) for k in range(n)])

    reference = (m.where(F.col(f"{p}by_chars") | F.col(f"{p}by_words")).groupBy(F.col(f"`{lang_col}`").alias(f"{p}lang"))
                 .agg(total(f"{p}classes", len(_CLASSES) + 1, f"{p}by_chars").alias(f"{p}ref_classes"),
                      total(f"{p}common", N_COMMON + 1, f"{p}by_words").alias(f"{p}ref_common")))
    joined = m.join(F.broadcast(reference), F.col(f"`{lang_col}`") == F.col(f"{p}lang"), "left")
    joined = (joined.withColumn(f"{p}char_distance", F.when(F.col(f"{p}by_chars"), distance(F.col(f"{p}classes"), F.col(f"{p}ref_classes"))))
              .withColumn(f"{p}word_distance", F.when(F.col(f"{p}by_words"), distance(F.col(f"{p}common"), F.col(f"{p}ref_common")))))
    near = ((F.coalesce(f"{p}char_distance", F.lit(0.0)) <= max_char_distance) & (F.coalesce(f"{p}word_distance", F.lit(0.0)) <= max_word_distance))
    joined = joined.withColumn(f"{p}kept", ~F.col(f"{p}base_failed") & near)
    own = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns if not (drop_text and c == text_col)], *[F.col(p + c) for c in own])
