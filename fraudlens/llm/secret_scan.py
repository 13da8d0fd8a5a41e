"""Secret scan with false positives removed by a random forest.

Every long run of key-like characters is a candidate, however many a word (text
between blanks) holds, and so is every value assigned to a name that says secret,
whatever its length and marks (of a quoted value with blanks, its first word).
Features of a candidate are its length and character classes, its character
transitions (how often its class changes, and how usual its letter pairs are in the
corpus), the share of it that dictionary words cover, whether it lies in a path or
address, the name before it, and the words beside it.  A random forest trained from
labelled findings decides.

The dictionary and the letter pairs are counted over all documents.  The labelled
findings are given, or else taken from the corpus by rules of high precision
(:func:`rule_labels`): formats of known key types and values assigned to a name
that says secret on one side, words, numbers and addresses on the other.

Only DataFrame operations and Spark's own forest are used.

Results in odd cases: null and empty texts have no candidates; without labelled
findings of both classes nothing is a secret and the score is null; repeated
rows give their findings each; rows without an id keep none; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import sampled, texts_of, written

#: Labelled findings of each class that the forest is trained on at most.
SAMPLE_ROWS = 10_000
TREES, DEPTH, SEED = 20, 6, 11
#: A candidate is a run of this length with a digit, or of the second without.
RUN, LONG_RUN = 12, 20
#: Occurrences that make a word part of the dictionary.
KNOWN = 5

#: Characters on each side of a candidate that its features look at.
AROUND = 256

#: Words that announce a secret, and formats of known key types.
NAMES = "(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|bearer|auth)"
ANNOUNCE = f"(?i){NAMES}"
FORMATS = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abpr]-[A-Za-z0-9-]{10,}$|^sk-[A-Za-z0-9]{20,}$|^AIza[A-Za-z0-9_-]{35}$"

#: A run by its own text, and a name that says secret with its mark of assignment.
KEY = "A-Za-z0-9+/_-"
LIKELY = f"(?=[A-Za-z+/_-]*[0-9])[{KEY}]{{{RUN},}}|[{KEY}]{{{LONG_RUN},}}"
ASSIGNS = NAMES + r"""[A-Za-z0-9_.-]{0,40}[\\"'`\]]{0,4}\x20?(?:=>|:=|[=:])+"""
OPENS = r"""(?:\\?["'`])?"""
#: What ends the field that a candidate is in, and the address.
FIELD, STRETCH = r"[^,;&?{}|)>\]]*", r"""[^"'`<>{}|,;]*"""
SPOT = "\x01"

FEATURES = [
    "length", "digits", "upper", "lower", "marks", "distinct", "changes", "pairs", "covered",
    "slashes", "address", "assigned", "announced", "quoted", "before_known", "after_known", "prefix_letters",
]


def _spots(word: Column, found: str) -> tuple[Column, Column]:
    """Of each match of ``found``: its text up to the next match, from the end of
    its first group on, and the place of that (from 0).  The text before the first
    match comes first, at 0."""
    marked = F.regexp_replace(word, found, f"$1{SPOT}$2")
    letters = F.split(marked, "")
    # linear in the word: a place is its mark's, less the marks up to it
    at = F.transform(F.filter(F.transform(letters, lambda c, i: F.when(c == SPOT, i)), lambda i: i.isNotNull()), lambda i, k: i - k)
    return F.split(marked, SPOT, -1), F.concat(F.array(F.lit(0)), at)


def _zipped(parts: Column, at: Column) -> Column:
    """offset, run and lead (the last characters before) for all parts but the first."""
    rows = F.zip_with(parts, at, lambda t, i: F.struct(i.alias("offset"), t.alias("run")))
    rows = F.transform(rows, lambda r, k: F.struct(r["offset"].alias("offset"), r["run"].alias("run"), F.right(F.get(parts, k - 1), F.lit(2)).alias("lead")))
    return F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))


def _value(text: Column, lead: Column) -> Column:
    """The assigned value that ``text`` begins with."""
    plain = F.regexp_extract(text, r"""(?is)^([^"'`]+?)(?=[,;&]+["']?[a-z_][a-z0-9_.-]{0,40}["']?[=:]|["'`]|$)""", 1)
    plain = F.regexp_replace(plain, r"[.,;(){}\[\]<>]+$", "")
    out = F.when(lead.rlike(r"""\\["'`]$"""), F.regexp_extract(text, r"""^[^"'`\\]*""", 0))
    for q in "\"'`":
        out = out.when(lead.endswith(q), F.regexp_extract(text, rf"(?s)^(?:[^{q}\\]++|\\.)*+", 0))
    return out.otherwise(plain)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, word_no and offset in the word (from 0), the run, what stands around it
    in the word (``left``, ``right``; ``word`` with the run) and the words beside."""
    text = F.translate("text", SPOT, "\x02")
    words = docs.where("text <> '' AND doc_id IS NOT NULL").select("doc_id", F.split(text, r"[ \t-\r]+").alias("words"))
    near = lambda i: F.coalesce(F.get("words", i), F.lit(""))
    announced = lambda before2, before: before.rlike("[=:>]$") & F.concat_ws(" ", before2, before).rlike(f"(?i){ASSIGNS}$")
    # cheap tests first: a length or one character costs less than a pattern
    at = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: ((F.length(F.get("words", i)) >= RUN) & F.get("words", i).rlike(LIKELY))
        | ((F.contains(F.get("words", i), F.lit("=")) | F.contains(F.get("words", i), F.lit(":"))) & F.get("words", i).rlike(f"(?i){ASSIGNS}."))
        | announced(near(i - 2), near(i - 1)),
    )
    beside = lambda step: near(F.col("word_no") + step)
    rows = words.select("doc_id", "words", F.explode(at).alias("word_no")).select(
        "doc_id", "word_no", F.get("words", F.col("word_no")).alias("word"), beside(-2).alias("before2"), beside(-1).alias("before"), beside(1).alias("after")
    )
    # runs, values assigned in the word, and the value that the word is or begins with
    parts, places = _spots(F.col("word"), f"()([{KEY}]{{{RUN},}})")
    named, named_at = _spots(F.col("word"), f"(?is)({ASSIGNS}{OPENS})()(?=.)")
    opened = F.regexp_extract("word", r"""^(?:=>|:=|[=:])*+""" + OPENS, 0)
    whole = F.struct(F.length(opened).alias("offset"), F.expr("substr(word, length(opened) + 1)").alias("run"), opened.alias("lead"))
    rows = rows.withColumns({"opened": opened, "parts": parts, "places": places, "named": named, "named_at": named_at})
    runs = F.transform(_zipped(F.col("parts"), F.col("places")), lambda r: F.struct(r["offset"].alias("offset"), F.regexp_extract(r["run"], f"^[{KEY}]+", 0).alias("run")))
    runs = F.filter(runs, lambda r: r["run"].rlike(LIKELY))
    values = F.concat(_zipped(F.col("named"), F.col("named_at")), F.when(announced(F.col("before2"), F.col("before")), F.array(whole)).otherwise(F.array().cast("array<struct<offset:int,run:string,lead:string>>")))
    values = F.transform(values, lambda r: F.struct(r["offset"].alias("offset"), _value(r["run"], r["lead"]).alias("run")))
    # a value that is a run is there already, as no character beside it is key-like
    values = F.filter(values, lambda r: r["run"].rlike(r"[^\[\](){}<>=:.,;|/\\-]") & ~r["run"].rlike(f"^(?:{LIKELY})$"))
    rows = rows.withColumns({"spot": F.concat(runs, values), "letters": F.split("word", "")})
    start = F.col("spot.offset")
    end = start + F.length("spot.run")
    cut = lambda first, n: F.array_join(F.slice("letters", first, n), "")
    rows = rows.select("doc_id", "word_no", "before2", "before", "after", "letters", F.explode("spot").alias("spot")).select(
        "doc_id", "word_no", start.alias("offset"), F.col("spot.run").alias("run"), "before2", "before", "after",
        cut(F.greatest(start - AROUND, F.lit(0)) + 1, F.least(start, F.lit(AROUND))).alias("left"), cut(end + 1, F.lit(AROUND)).alias("right"),
    )
    return rows.withColumn("word", F.concat("left", "run", "right"))


def dictionary(docs: DataFrame, known: int = KNOWN) -> DataFrame:
    """Lower-case letter words of all documents that occur at least ``known`` times, and how often."""
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("term")).where("length(term) >= 2")
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= known)


def letter_pairs(terms: DataFrame) -> DataFrame:
    """Logarithm of how often each pair of ASCII letters follows in words, per thousand."""
    pairs = terms.where("term RLIKE '^[a-z]+$'").select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("term") - 1), lambda i: F.substr("term", i, F.lit(2)))).alias("pair"))
    counted = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    total = counted.agg(F.sum("n").alias("total"))
    return counted.crossJoin(F.broadcast(total)).select("pair", F.log1p(1000.0 * F.col("n") / F.col("total")).alias("usual"))  # 676 rows, one total


def _share(run: Column, pattern: str) -> Column:
    return (F.length(run) - F.length(F.regexp_replace(run, pattern, ""))) / F.length(run)


def featured(found: DataFrame, terms: DataFrame, pairs: DataFrame) -> DataFrame:
    """Candidates with FEATURES.  Equal runs share the features that need a join."""
    run = F.col("run")
    own = found.select("run").distinct()
    parts = own.select("run", F.explode(F.regexp_extract_all(F.lower("run"), F.lit("[a-z]{2,}"), F.lit(0))).alias("term"))
    covered = parts.join(terms, "term").groupBy("run").agg(F.sum(F.length("term")).alias("covered_letters"))
    letters = F.regexp_replace(F.lower("run"), "[^a-z]", "")
    two = own.select("run", letters.alias("letters")).where("length(letters) > 1")
    two = two.select("run", F.explode(F.transform(F.sequence(F.lit(1), F.length("letters") - 1), lambda i: F.substr("letters", i, F.lit(2)))).alias("pair"))
    usual = two.join(F.broadcast(pairs), "pair", "left").groupBy("run").agg(F.avg(F.coalesce("usual", F.lit(0.0))).alias("pairs"))
    shared = own.join(covered, "run", "left").join(usual, "run", "left")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(run, "[0-9]+", "0"), "[A-Z]+", "A"), "[a-z]+", "a"), "[+/_-]+", "-")
    known = lambda c: F.regexp_replace(c, r"[^\p{L}]", "")
    flag = lambda c: c.cast("double")
    if "left" not in found.columns:
        found = found.withColumns({"left": F.expr("substring_index(word, run, 1)"), "right": F.expr("substr(word, length(substring_index(word, run, 1)) + length(run) + 1)")})
    rows = found.join(shared, "run").withColumn("lead", F.regexp_extract("left", f"{FIELD}$", 0))
    # the words beside count for a candidate whose field reaches them
    first = (F.length("lead") == F.length("left")) & (F.length("left") < AROUND)
    last = F.col("right").rlike(f"^{FIELD}[^A-Za-z0-9]*$") & (F.length("right") < AROUND)
    rows = rows.withColumns({c: F.when(first, F.col(c)).otherwise("") for c in ("before2", "before")} | {"after": F.when(last, F.col("after")).otherwise("")})
    rows = rows.withColumn("stretch", F.concat(F.regexp_extract("left", f"{STRETCH}$", 0), "run", F.regexp_extract("right", f"^{STRETCH}", 0)))
    return rows.withColumns(
        {
            "length": flag(F.length(run)),
            "digits": _share(run, "[0-9]"),
            "upper": _share(run, "[A-Z]"),
            "lower": _share(run, "[a-z]"),
            "marks": _share(run, "[+/_-]"),
            "distinct": F.size(F.array_distinct(F.split(run, ""))) / F.length(run),
            "changes": F.length(classes) / F.length(run),
            "pairs": F.coalesce("pairs", F.lit(0.0)),
            "covered": F.coalesce("covered_letters", F.lit(0)) / F.length(run),
            "slashes": flag(F.length("stretch") - F.length(F.regexp_replace("stretch", "/", ""))),
            "address": flag(F.col("stretch").rlike(r"(?i)https?:|www\.|@|\.(com|org|net|html?)")),
            "assigned": flag(F.col("lead").rlike("[=:]") | F.col("before").rlike("[=:]$")),
            "announced": flag(F.concat_ws(" ", "before2", "before", "lead").rlike(ANNOUNCE)),
            "quoted": flag(F.col("left").rlike("[\"'`]$")),
            "before_known": flag(F.length(known(F.col("before"))) > 1),
            "after_known": flag(F.length(known(F.col("after"))) > 1),
            "prefix_letters": flag(F.length(F.regexp_extract(run, "^([A-Z]{3,5})", 1))),
        }
    )


def rule_labels(rows: DataFrame) -> DataFrame:
    """Findings that rules can label: 1 for known formats and for values given to a
    name that says secret, 0 for words, numbers, paths and addresses; others go."""
    mixed_run = F.col("run").rlike("[0-9]") & F.col("run").rlike("[A-Za-z]")
    secret = F.col("run").rlike(FORMATS) | ((F.col("announced") == 1) & (F.col("assigned") == 1) & mixed_run)
    plain = F.col("run").rlike("^[A-Za-z]+$|^[0-9]+$|^[0-9_/+-]+$") | (F.col("address") == 1) | F.col("run").rlike("^(/?[a-z]+)+/?$|^([A-Za-z]+[-_])+[A-Za-z]+$")
    return rows.withColumn("label", F.when(secret, 1.0).when(plain, 0.0)).where("label IS NOT NULL")


def train(labelled: DataFrame) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (FEATURES and label), at most SAMPLE_ROWS of each class."""
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, SAMPLE_ROWS / n if n > SAMPLE_ROWS else 2.0)])
    sample = written(labelled.where(sampled(F.element_at(share, F.col("label")), "run", "doc_id", "word_no")).limit(3 * SAMPLE_ROWS).select("label", *FEATURES), "findings")
    if sample.select("label").distinct().count() < len(sizes):
        raise ValueError(f"a class of the labelled findings has no sample: {sizes}")
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(table)


def secret_scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, word_no, offset, word (up to AROUND characters on each side of the run),
    run, score (chance of a secret) and secret of every candidate.  ``labelled``, if given, has run, word, before2, before, after,
    doc_id, word_no and label (0 or 1)."""
    docs = texts_of(docs, id_col, text_col)
    found = written(candidates(docs), "candidates")
    terms = written(dictionary(docs), "dictionary")
    pairs = written(letter_pairs(terms), "letter-pairs")
    rows = written(featured(found, terms, pairs), "featured")
    model = train(rule_labels(rows) if labelled is None else featured(labelled, terms, pairs))
    if model is None:
        return rows.select("doc_id", "word_no", "offset", "word", "run", F.lit(None).cast("double").alias("score"), F.lit(False).alias("secret"))
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
    score = F.element_at(vector_to_array("probability"), 2)
    return scored.select("doc_id", "word_no", "offset", "word", "run", score.alias("score")).withColumn("secret", F.col("score") >= 0.5)
