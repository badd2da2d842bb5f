"""Secret scan with a random forest that removes false positives.

Candidates are long tokens. Their features are native expressions: length, character classes
and transitions, coverage by a dictionary of frequent words, path and neighbouring words.
A random forest trained from labelled findings says which are secrets.
"""

from __future__ import annotations

import functools

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.store import written

#: Java patterns: white space between words, and a candidate inside a word.
SPACE = r"[\x20\x09-\x0D]+"
CANDIDATE = r"([A-Za-z0-9+/_\-]{16,}={0,2})"
#: Entries of the dictionary: the most frequent words of 3 to 8 letters.
DICTIONARY_WORDS = 300
#: Labelled findings of each class that the forest is trained on at most (a hash picks them).
MAX_TRAIN = 20_000
TREES = 20
DEPTH = 7
SEED = 13
#: Fixed values. Words near a finding that speak for a secret, that speak against one, and parts of a path with examples.
HINTS = "secret|token|passw|passwd|pwd|api.?key|apikey|access.?key|credential|auth|bearer|private"
AGAINST = "example|sample|dummy|placeholder|changeme|test|fake|xxxx|sha1|sha256|md5|checksum|commit|uuid|hash"
EXAMPLE_PATH = "test|example|sample|mock|fixture|demo|doc"
FEATURES = ("length", "digits", "upper", "lower", "other", "hex", "changes", "letter_digit", "longest_run", "distinct", "vowels",
            "dictionary", "path_depth", "path_example", "hint_before", "hint_inside", "hint_after", "against", "assigned", "quoted", "whole_word")
#: What a word and its neighbours say, once for all matches inside the word.
NEAR = ("hint_before", "hint_after", "against_near", "assigned_before", "whole_word", "address")
#: Characters of the neighbouring words that a finding shows.
SHOWN = 200


def _says(column: str, pattern: str) -> Column:
    return F.lower(F.col(column)).rlike(pattern)


def candidates(docs: DataFrame) -> DataFrame:
    """Long tokens of every text, a row for each match: ``doc_id``, ``path``, ``place`` (number of the word), ``part`` (number of
    the match in the word), ``value``, ``lead``, ``before`` (up to two words), ``after`` (one word) and what the words say as a
    whole (NEAR). ``path`` is the column ``source``.

    ``lead`` is the text of the word before the match, from the match before it on; ``before`` and ``after``
    show the SHOWN characters next to the word, while NEAR is taken from the whole words. So a word with many matches takes no more room than its text
    and a bounded number of characters a match.
    """
    words = docs.filter(F.col("text").rlike(CANDIDATE)).select("doc_id", F.col("source").alias("path"), F.split("text", SPACE).alias("w"))
    near = lambda i: F.coalesce(F.get("w", i), F.lit(""))
    # Each matching word with its neighbours: the rows carry these, not the text's array of words.
    hit = F.filter(F.transform("w", lambda x, i: F.when(x.rlike(CANDIDATE), F.struct(
        i.cast("long").alias("place"), x.alias("word"), F.concat_ws(" ", near(i - 2), near(i - 1)).alias("before"), near(i + 1).alias("after")))), lambda x: x.isNotNull())
    at = words.select("doc_id", "path", F.inline(hit))
    says = {
        "hint_before": _says("before", HINTS), "hint_after": _says("after", HINTS), "against_near": _says("before", AGAINST) | _says("after", AGAINST),
        "assigned_before": F.col("before").rlike("[=:]$"), "whole_word": F.col("word").rlike(f"^{CANDIDATE}$"), "address": F.col("word").rlike("^https?://"),
    }
    found = F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(1))
    # The texts between the matches, the match before each and the match; behind the last match there is none.
    pieces = F.arrays_zip(F.split("word", CANDIDATE, -1).alias("gap"), F.concat(F.array(F.lit("")), found).alias("last"), found.alias("value"))
    at = at.select("doc_id", "path", "place", "word", F.right("before", F.lit(SHOWN)).alias("before"), F.left("after", F.lit(SHOWN)).alias("after"), *[c.alias(k) for k, c in says.items()])
    at = at.select("doc_id", "path", "place", "before", "after", *NEAR, F.posexplode(pieces).alias("part", "m")).filter("m.value is not null")
    return at.select("doc_id", "path", "place", F.col("part").cast("long").alias("part"), "m.value", F.concat("m.last", "m.gap").alias("lead"), "before", "after", *NEAR)


def dictionary(docs: DataFrame, size: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent plain words of 3 to 8 letters in all texts; of equal counts the smaller word."""
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).filter(F.length("word").between(3, 8))
    top = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return sorted(r["word"] for r in top.collect())


def _count(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)).cast("double")


def features(found: DataFrame, words: list[str]) -> DataFrame:
    """``found`` with a column for each of FEATURES."""
    v, n = F.col("value"), F.length("value").cast("double")
    kinds = v
    for pattern, kind in (("[0-9]", "\u0001"), ("[A-Z]", "\u0002"), ("[a-z]", "\u0003"), ("[^\u0001-\u0003]", "\u0004")):
        kinds = F.regexp_replace(kinds, pattern, kind)
    runs = F.regexp_extract_all(kinds, F.lit(r"((.)\2*)"), F.lit(1))
    # Longest words first: a pattern of bounded size.
    known = "|".join(sorted(words, key=lambda w: (-len(w), w))) or "$^"
    lead = F.col("lead")
    path = F.lower(F.coalesce("path", F.lit("")))
    cols = {
        "length": n, "digits": _count(v, "[0-9]") / n, "upper": _count(v, "[A-Z]") / n, "lower": _count(v, "[a-z]") / n, "other": _count(v, "[^A-Za-z0-9]") / n,
        "hex": v.rlike("^[0-9a-f]+$").cast("double"), "changes": (F.size(runs) - 1) / n,
        "letter_digit": F.regexp_count(kinds, F.lit("[\u0002\u0003]\u0001|\u0001[\u0002\u0003]")) / n,
        "longest_run": F.array_max(F.transform(runs, F.length)) / n, "distinct": F.size(F.array_distinct(F.split(v, ""))) / n,
        "vowels": _count(F.lower(v), "[aeiouy]") / n,
        "dictionary": 1 - F.length(F.regexp_replace(F.lower(v), known, "")) / n,
        "path_depth": _count(path, "/"), "path_example": path.rlike(EXAMPLE_PATH).cast("double"),
        "hint_before": F.col("hint_before"), "hint_inside": _says("lead", HINTS), "hint_after": F.col("hint_after"),
        "against": F.col("against_near") | _says("lead", AGAINST), "assigned": lead.rlike("[=:]") | F.col("assigned_before"),
        "quoted": lead.rlike("[\"'`]$"), "whole_word": F.col("whole_word"),
    }
    return found.withColumns({k: F.coalesce(c.cast("double"), F.lit(0.0)) for k, c in cols.items()})


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def train(labelled: DataFrame, limit: int = MAX_TRAIN, seed: int = SEED) -> RandomForestClassificationModel | None:
    """A forest from labelled findings: the columns FEATURES, ``value`` and ``label`` (0 or 1; null rows do not count).

    At most about ``limit`` findings of each class are used. None if the findings are not of both classes.
    """
    known = labelled.filter(F.col("label").isin(0, 1))
    count = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(count) < 2:
        return None
    share = functools.reduce(lambda c, k: F.when(F.col("label") == k, F.lit(min(1.0, limit / count[k]))).otherwise(c), count, F.lit(1.0))
    place = F.pmod(F.xxhash64("value", "before", "after", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Sorted in a bounded number of tasks, as the trees' samples follow the order of the rows.
    rows = written(_assembled(known.filter(place < share)).select("features", F.col("label").cast("double").alias("label"), place.alias("place"))
                   .coalesce(8).sortWithinPartitions("place"), "findings")
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt").fit(rows)


def judged(rows: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """``rows`` with ``probability`` (of being a secret) and ``secret``; without a model all candidates are taken for secrets."""
    if model is None:
        return rows.withColumn("probability", F.lit(1.0)).withColumn("secret", F.lit(True))
    keep = rows.columns
    got = model.transform(_assembled(rows)).withColumn("p", F.round(F.get(vector_to_array("probability"), F.lit(1)), 9))
    return got.select(*keep, F.col("p").alias("probability"), (F.col("p") >= 0.5).alias("secret"))


def known_findings(rows: DataFrame) -> DataFrame:
    """Labels where the form of a finding leaves no doubt (null elsewhere).

    1: an access key id in its fixed form, or a value of hex digits assigned to a name of HINTS.
    0: letters only and nothing assigned, or an address inside a path.
    """
    assigned = F.concat_ws(" ", "before", "lead")
    sure = F.col("value").rlike("^AKIA[0-9A-Z]{16}$") | (F.col("value").rlike("^[0-9a-f]{16,}$") & F.lower(assigned).rlike(f"(?:{HINTS})[^ ]* ?[=:] ?[\"']?$"))
    plain = F.col("value").rlike(r"^[A-Za-z]+$") | F.col("address")
    return rows.withColumn("label", F.when(sure, 1).when(plain & ~sure & ~assigned.rlike("[=:] ?[\"']?$"), 0))


def scan(docs: DataFrame, labelled: DataFrame | None = None, limit: int = MAX_TRAIN) -> DataFrame:
    """Candidates of all texts with the forest's verdict.

    ``docs`` needs ``doc_id``, ``text`` and ``source`` (used as path). ``labelled``: findings with
    FEATURES, ``value``, ``before``, ``after`` and ``label``; without it, the candidates of
    ``docs`` whose form leaves no doubt are the labelled findings. Returns ``doc_id``, ``path``,
    ``place``, ``part``, ``value``, ``lead``, ``before``, ``after``, FEATURES, ``probability``, ``secret`` and the rest of NEAR.
    Every match inside a word is a candidate of its own: ``doc_id``, ``place`` and ``part`` name it.

    Null and empty texts have no candidates; a null ``source`` is an empty path; a null ``doc_id``
    is passed on; repeated rows give their candidates each. Other columns are
    ignored. An empty table gives an empty result. A text of any length is searched whole.
    """
    rows = written(features(candidates(docs), dictionary(docs)), "candidates")
    model = train(known_findings(rows) if labelled is None else labelled, limit)
    return judged(rows, model)
