"""Secret scan: candidates by pattern, false positives removed by a random forest.

Native throughout: DataFrame functions and Spark's own random forest.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.llm.common import materialise

#: What may be a secret: a long run of the characters that keys are made of.
CANDIDATE = r"[A-Za-z0-9+/_=~.-]{16,}"
#: Or whatever is given to a credential: in quotes, or up to white space, a quote or what ends a value in prose, markup and URLs.
_NAME = r"[A-Za-z0-9+/_=~.-]*?(?i:password|passwd|secret|token|api_?key)[\"']?\s*[:=]\s*"
_PLAIN = r"(?!&\w+=|</)[^\s\"']"
SHORTEST = 4
_VALUE = rf"(?:\"[^\"\n]{{{SHORTEST},128}}(?=\")|'[^'\n]{{{SHORTEST},128}}(?=')|[\"']?(?:{_PLAIN}){{{SHORTEST - 1},}}(?![,;:)\]}}>]){_PLAIN})"
GIVEN = f"{_NAME}{_VALUE}"
#: Texts without any of these give nothing to a credential.
HINTS = ["passw", "secret", "token", "apikey", "api_key"]
#: Findings that are claimed to be secrets by their issuer's format, or as the value given to a credential.
ISSUED = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)$"
ASSIGNED = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\s*[:=]\s*[\"']?$"
SPEAKING = r"(?i)(pass|pwd|secret|token|key|auth|cred|bearer)"
CONTEXT = 48
#: What the forest sees: the candidate's own form and the words around it, but not the assignment
#: or the issuer's format that labels it, so that it can overrule a label.
FEATURES = ["length", "digit_share", "upper_share", "transitions", "coverage", "path_marks", "words_before", "words_after", "named_near", "quoted"]


def candidates(documents: DataFrame) -> DataFrame:
    """(doc_id, start, found, before, after) for every candidate in documents (doc_id, text).

    start counts characters from 1; before and after are up to CONTEXT characters beside it. A
    candidate matches CANDIDATE, or is a value of SHORTEST characters and more that follows the
    name of a credential. A value joined to its name, as in password=..., is cut after it. Null
    and empty texts have none; repeated rows give their findings again. Texts are searched once:
    what is found is written to the shared folder.
    """
    named = F.greatest(*(F.contains(F.lower("text"), F.lit(x)) for x in HINTS))
    hits = documents.select("doc_id", "text").where(F.col("text").rlike(CANDIDATE) | named)
    found, gaps = (F.when(named, of(f"{GIVEN}|{CANDIDATE}")).otherwise(of(CANDIDATE)) for of in (lambda x: F.regexp_extract_all("text", F.lit(f"({x})"), F.lit(1)), lambda x: F.split("text", x, -1)))
    hits = hits.select(F.monotonically_increasing_id().alias("row"), "doc_id", found.alias("found"), gaps.alias("gaps"))
    parts = F.arrays_zip(F.col("found"), F.expr("slice(gaps, 1, size(found))").alias("gap"), F.expr("slice(gaps, 2, size(found))").alias("next"))
    each = hits.select("row", "doc_id", F.posexplode(parts).alias("k", "x"))
    each = each.select("row", "doc_id", "k", "x.found", (F.length("x.gap") + F.length("x.found")).alias("n"), F.expr(f"right(x.gap, {CONTEXT})").alias("gap"), F.expr(f"left(x.next, {CONTEXT})").alias("next"))
    # Where a candidate ends: the lengths of all gaps and candidates of its text up to it.
    so_far = Window.partitionBy("row").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    each = materialise(each, "found").withColumn("start", F.sum("n").over(so_far) - F.length("found") + 1)
    each = each.select("doc_id", F.struct("found", "gap", "next", "start").alias("x"))
    name = F.when(F.col("x.found").rlike(f"^{_NAME}"), F.regexp_extract("x.found", f"^({_NAME}[\"']?)", 1)).otherwise("")
    cut = F.when(F.length("x.found") - F.length(name) >= SHORTEST, name).otherwise("")
    cut = F.when(cut != "", cut).otherwise(F.regexp_extract("x.found", r"^([A-Za-z_.-]{2,24}=)[^=]", 1))
    row = each.select("doc_id", "x", cut.alias("cut"))
    row = row.select("doc_id", (F.col("x.start") + F.length("cut")).cast("long").alias("start"), F.expr("substring(x.found, length(cut) + 1)").alias("found"), F.concat("x.gap", "cut").alias("before"), F.col("x.next").alias("after"))
    return row.where((F.length("found") >= 16) | ((F.length("found") >= SHORTEST) & F.col("before").rlike(ASSIGNED)))


def dictionary(documents: DataFrame, share: float = 1e-4) -> list[str]:
    """Words of three to twelve letters that are at least `share` of all such words of all documents, and so 1 / share at most."""
    words = documents.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\b([a-z]{3,12})\b"), F.lit(1))).alias("word"))
    counted = materialise(words.groupBy("word").agg(F.count("*").alias("n")), "words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    return sorted(r["word"] for r in counted.where(F.col("n") >= share * total).collect())


def _any_of(words: list[str]) -> str:
    """A pattern for the longest of `words` at a place, as a tree of their letters."""
    tree: dict = {}
    for word in words:
        node = tree
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        parts = [letter + pattern(more) for letter, more in sorted(node.items()) if letter]
        return f"(?:{'|'.join(parts)}){'?' if '' in node else ''}" if parts else ""

    return pattern(tree)


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    """The columns of FEATURES beside those of `candidates`."""
    n = F.length("found")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace("found", "[A-Z]+", "U"), "[a-z]+", "l"), "[0-9]+", "d")
    plain = F.lower("found")
    known = _any_of(words)
    rest = F.regexp_replace(plain, known, "") if words else plain

    def spoken(text):
        """The share of dictionary words in a text's letters."""
        letters = F.regexp_replace(F.lower(text), "[^a-z]+", " ")
        left = F.regexp_replace(letters, rf"\b{known}\b", "") if words else letters
        size = F.length(F.translate(letters, " ", ""))
        return F.when(size > 0, 1 - F.length(F.translate(left, " ", "")) / size).otherwise(0.0)

    # Up to the word that may name the candidate.
    earlier = F.regexp_replace("before", r"\S+\s*[:=]?\s*[\"']?$", "")
    return found.withColumns(
        {
            "length": n.cast("double"),
            "digit_share": F.length(F.regexp_replace("found", "[^0-9]", "")) / n,
            "upper_share": F.length(F.regexp_replace("found", "[^A-Z]", "")) / n,
            "transitions": F.length(kinds) / n,
            "coverage": 1 - F.length(rest) / n,
            "path_marks": (F.length(F.regexp_replace("found", "[^/.]", "")) + F.col("before").rlike(r"(://|[/\\])\S*$").cast("int")).cast("double"),
            "words_before": spoken(earlier),
            "words_after": spoken(F.col("after")),
            "named_near": (earlier.rlike(SPEAKING) | F.col("after").rlike(SPEAKING)).cast("double"),
            "quoted": F.col("after").rlike("^[\"']").cast("double"),
        }
    )


def label(found: DataFrame) -> DataFrame:
    """Findings with `label`: 1 if a pattern claims them, an issuer's format or an assignment to a credential, else 0."""
    return found.withColumn("label", (F.col("found").rlike(ISSUED) | F.col("before").rlike(ASSIGNED)).cast("double"))


#: What denies that a finding is a secret: no digit or nothing else, the name of a host, or a word that stands for a value.
DENIED = r"(?i)^[^0-9]*$|^[0-9.+-]*$|\.(com|org|net|io|edu|gov|html?|png|jpe?g|js|css)\b|example|sample|changeme|placeholder|dummy|your_|<|x{4}|\*{3}"


def agreed(found: DataFrame) -> DataFrame:
    """Findings with `label`: 1 where a pattern claims them and none denies them, 0 where it is the other way round, null where patterns contradict one another or are silent."""
    denied = F.col("found").rlike(DENIED)
    claimed = label(found)
    return claimed.withColumn("label", F.when((F.col("label") == 1) & ~denied, 1.0).when((F.col("label") == 0) & denied, 0.0))


def held_out():
    """Documents whose findings teach nothing by default: those of crc32(doc_id as text) mod 4 = 2, and of null ids."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit(labelled: DataFrame, max_findings: int = 20_000, trees: int = 20, depth: int = 6) -> RandomForestClassificationModel | None:
    """A forest over FEATURES, from at most `max_findings` labelled findings of each label, those of least hash.

    None if the findings do not hold both labels.
    """
    least = [labelled.where(F.col("label") == y).orderBy(F.xxhash64("found", "before"), "found", "before", "doc_id", "start").limit(max_findings) for y in (0.0, 1.0)]
    sample = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(least[0].unionByName(least[1])).select("label", "features")
    if sample.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7).fit(sample)


def scan(documents: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """(doc_id, start, length, found, score, secret, claimed, held_out), a row for each candidate of documents (doc_id, text).

    score is the forest's share for a secret; secret is score >= threshold; claimed is what
    the patterns of `label` say. `labelled` has findings with before, after and label; by default
    the forest learns from the documents' own candidates that `agreed` labels and that are not
    held out, and decides on all: on held-out ones it has not seen, and on those where the patterns
    contradict one another or say nothing. It does not see assignments and formats, so what looks
    like prose is no secret though it is given to a password. Without both labels, claimed is the score.
    """
    words = dictionary(documents)
    found = materialise(label(with_features(candidates(documents), words)).withColumnRenamed("label", "claim").withColumn("held_out", held_out()), "features")
    model = fit(agreed(found).where("label IS NOT NULL AND NOT held_out") if labelled is None else with_features(labelled, words))
    if model is None:
        scored = found.withColumn("score", F.col("claim"))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", F.length("found").cast("long").alias("length"), "found", "score", (F.col("score") >= threshold).alias("secret"), (F.col("claim") == 1).alias("claimed"), "held_out")
