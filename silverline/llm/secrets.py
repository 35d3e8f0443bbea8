"""Secret scan: long tokens, of which a random forest removes what is no secret."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import materialise, words

#: A candidate: a long run of characters that keys, tokens and hashes are made of.
CANDIDATE, SHORTEST = r"[A-Za-z0-9_+/-]{16,}={0,2}", 16
#: What may stand between an @ and another part of its mail address.
IN_MAIL = r"[^\s@\"',;:=&?<>(){}\[\]]"
#: Neighbours that speak for a secret, and neighbours or paths that speak against one.
FOR = r"(?i)(key|token|secret|passw|pwd|auth|credential|private|bearer)"
AGAINST = r"(?i)(sha\d*|md5|hash|digest|commit|checksum|uuid|revision|version|example|sample|test|mock|fixture)"
#: Words of the dictionary, labelled findings used in training, and the size of the forest.
DICTIONARY, LABELLED, TREES, DEPTH = 4096, 20_000, 24, 6
#: What the letters of a word turn into in the transition table: a to z, digits, everything else, the ends.
SYMBOLS = 29
FEATURES = [
    "length", "digits", "uppers", "changes", "transitions", "distinct", "coverage", "slashes", "in_path", "in_test_path",
    "before_for", "before_against", "after_against", "assigned", "quoted", "at_sign",
]


@dataclass(frozen=True)
class Dictionary:
    """The most frequent words of a corpus, and log probabilities of a letter after a letter in them."""

    words: tuple[str, ...]
    transitions: tuple[float, ...]


def dictionary(docs: DataFrame, *, text_col: str = "text", size: int = DICTIONARY) -> Dictionary:
    """Count the words of the whole corpus and keep the most frequent ones of three and more letters a to z, ties by spelling.

    Counts are summed in every task before the shuffle; `size` words come to the driver.
    """
    plain = F.transform(words(F.lower(F.col(text_col))), lambda x: F.btrim(x, F.lit(".,;:!?\"'()")))
    counted = docs.select(F.explode(plain).alias("w")).where(F.col("w").rlike("^[a-z]{3,15}$")).groupBy("w").count()
    top = counted.orderBy(F.desc("count"), "w").limit(size).collect()
    pairs = [[1.0] * SYMBOLS for _ in range(SYMBOLS)]
    for w, n in top:
        path = [SYMBOLS - 1, *(ord(c) - 97 for c in w), SYMBOLS - 1]
        for a, b in zip(path, path[1:]):
            pairs[a][b] += math.log1p(n)
    logs = tuple(round(math.log(x / sum(row)), 6) for row in pairs for x in row)
    return Dictionary(tuple(sorted(w for w, _ in top)), logs)


def candidates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source"
) -> DataFrame:
    """Every long token with its surroundings: `id`, `word` (its place among the words of the text, from 0), `place` (its place among the
    candidates of that word, from 0), `candidate`, `token` (the part of the word around it), `head` (the part of `token` before it), `mail`
    (whether an @ joins it to the text beside it), `before2`, `before`, `after` (neighbouring words), `path`.

    A word yields all its candidates. What is around one reaches from the start of the candidate before it to the end of the text before
    the one after it; the first of a word has the words before as neighbours and the last the word after, the others
    have empty ones. So rows grow with the text, also where one word holds very many candidates. Null and empty texts have none; missing
    neighbours and paths are empty strings; null ids stay null; repeated rows repeat their findings.
    """
    w = F.col("w")
    near = lambda i: F.coalesce(F.get(w, i), F.lit(""))
    found = F.transform(
        w,
        lambda x, i: F.when(
            (F.octet_length(x) >= SHORTEST) & x.rlike(CANDIDATE),
            F.struct(
                i.alias("word"), x.alias("token"), near(i - 2).alias("before2"), near(i - 1).alias("before"), near(i + 1).alias("after")
            ),
        ),
    )
    path = F.col(path_col) if path_col else F.lit("")
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(path.cast("string"), F.lit("")).alias("path"), words(F.col(text_col)).alias("w")
    )
    rows = rows.select("id", "path", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("f")).select("id", "path", "f.*")
    # The text between candidates: one piece before each, and one after the last.
    rows = rows.withColumns(
        {"found": F.regexp_extract_all("token", F.lit(CANDIDATE), F.lit(0)), "gaps": F.split("token", CANDIDATE)}
    )
    first, last = lambda i: i == 0, lambda i: i == F.size("found") - 1
    around = F.transform(
        "found",
        lambda c, i: F.struct(
            c.alias("candidate"),
            F.concat(F.when(first(i), "").otherwise(F.get("found", i - 1)), F.get("gaps", i)).alias("head"),
            F.get("gaps", i + 1).alias("tail"),
            (F.get("gaps", i).rlike(f"@{IN_MAIL}*$") | F.get("gaps", i + 1).rlike(f"^{IN_MAIL}*@")).alias("mail"),
            F.when(first(i), F.col("before2")).otherwise("").alias("before2"),
            F.when(first(i), F.col("before")).otherwise("").alias("before"),
            F.when(last(i), F.col("after")).otherwise("").alias("after"),
        ),
    )
    rows = rows.select("id", "word", F.posexplode(around).alias("place", "c"), "path").select("id", "word", "place", "c.*", "path")
    return rows.select(
        "id", "word", "place", F.concat("head", "candidate", "tail").alias("token"), "head", "mail",
        "before2", "before", "after", "path", "candidate",
    )


def features(found: DataFrame, known: Dictionary) -> DataFrame:
    """Add the forest's features to candidates: numbers made of the candidate, its word, its path and its neighbours."""
    c = F.col("candidate")
    size = F.length(c).cast("double")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    changes = F.length(F.regexp_replace(kinds, r"(.)\1*", "x")) - 1
    letters = F.split(F.lower(c), "")
    table = F.split(F.lit(",".join(map(str, known.transitions))), ",").cast("array<double>")
    code = lambda x: (
        F.when(x.between("a", "z"), F.ascii(x) - 97).when(x.between("0", "9"), F.lit(26)).otherwise(F.lit(27))
    )
    ends = F.lit(SYMBOLS - 1)
    walked = F.aggregate(
        letters,
        F.struct(F.lit(0.0).alias("sum"), ends.alias("at")),
        lambda s, x: F.struct((s["sum"] + F.get(table, s["at"] * SYMBOLS + code(x))).alias("sum"), code(x).alias("at")),
        lambda s: s["sum"],
    )
    listed = ",".join(f"'{w}'" for w in known.words) or "''"
    covered = F.expr(
        f"aggregate(filter(split(lower(candidate), '[^a-z]+'), x -> x in ({listed})), 0, (s, x) -> s + length(x))"
    )
    flag = lambda test: test.cast("double")
    head = F.col("head")
    before = F.concat_ws(" ", F.col("before2"), F.col("before"), head)
    return found.withColumns(
        {
            "length": size,
            "digits": F.length(F.regexp_replace(c, "[^0-9]", "")) / size,
            "uppers": F.length(F.regexp_replace(c, "[^A-Z]", "")) / size,
            "changes": changes / size,
            "transitions": walked / size,
            "distinct": F.size(F.array_distinct(letters)) / size,
            "coverage": covered / size,
            "slashes": F.length(F.regexp_replace("token", "[^/]", "")).cast("double"),
            "in_path": flag(F.col("token").rlike("://|\\.[a-z]{2,4}(/|$)")),
            "in_test_path": flag(F.col("path").rlike(AGAINST)),
            "before_for": flag(before.rlike(FOR)),
            "before_against": flag(before.rlike(AGAINST)),
            "after_against": flag(F.col("after").rlike(AGAINST)),
            "assigned": flag(F.concat("before", head).rlike("[=:]")),
            "quoted": flag(head.rlike("[\"']$")),
            "at_sign": flag(F.col("mail")),
        }
    )


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def fit(
    findings: DataFrame, known: Dictionary, *, labelled: int = LABELLED, seed: int = 1
) -> RandomForestClassificationModel | None:
    """Train the forest on labelled findings: candidates with `label`, 1 for a secret and 0 for none.

    Uses at most `labelled` findings of either label, those with the smallest hashes, in one order, so training
    repeats. Findings that agree in everything count once, null labels not at all. Without findings of both labels there is no
    model, and a scan keeps every candidate.
    """
    columns = ["token", "before2", "before", "after", "path", "candidate"]
    rows = findings.where("label in (0, 1)").groupBy(*columns, "head", "mail").agg(F.max(F.col("label").cast("double")).alias("label"))
    rows = rows.withColumn("h", F.xxhash64(*columns))
    some = [rows.where(F.col("label") == k).orderBy("h", "candidate", "head").limit(labelled) for k in (0.0, 1.0)]
    bounded = materialise(some[0].union(some[1]), "findings")
    if bounded.select("label").distinct().count() < 2:
        return None
    train = _assembled(features(bounded, known)).select("features", "label", "h", "head").repartition(1).sortWithinPartitions("h", "label", "head")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="onethird")
    # a copy has no training summary, whose session cannot travel to tasks once an observation was made in it
    return forest.fit(train).copy()


def scan(found: DataFrame, known: Dictionary, model: RandomForestClassificationModel | None) -> DataFrame:
    """Score candidates and tell which are secrets: adds `score`, the forest's share of votes from 0 to 1 in steps of
    a millionth, and `secret`, true from one half on."""
    if model is None:
        return found.withColumn("score", F.lit(1.0)).withColumn("secret", F.lit(True))
    scored = model.transform(_assembled(features(found, known)))
    score = F.round(F.get(vector_to_array("probability"), F.lit(1)), 6)
    return scored.select(*found.columns, score.alias("score"), (score >= 0.5).alias("secret"))
