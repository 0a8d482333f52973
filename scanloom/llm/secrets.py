"""Secret scan: candidates by pattern, false positives out by a random forest.

A candidate is a run of 16 or more key characters with a digit in it, a value of 8 or more characters after a key name and
a sign (password = "..", API_KEY=.., also without a digit), or what begins as keys of well-known providers do; names and
signs are not part of it. Its features are its length, its characters (classes, distinct ones, transitions between classes),
its dictionary coverage, its document's path, and the words and signs around it. Coverage is the share of its runs of four
letters that occur in words of the corpus, counted over all documents: in those of at least `MIN_DOCS` of them. The
forest (Spark ML, on the JVM) is trained on labelled findings; a candidate is reported if its probability reaches the threshold.

Findings to learn from are a table of candidates with the same context columns and a label. `derived_findings` makes one of
bounded size where there is none: keys and look-alikes of known kind set into contexts of the corpus, and the corpus' own
candidates that neither a name nor a provider's prefix speaks for, as look-alikes.

Built-in functions only. A filter finds the texts with a candidate; each is cut at its candidates once, and from there on
rows are pieces, of which a text with many candidates has as many.

Cases: a null text is empty; a candidate that occurs more than once in a text is one row with its first place and its number of
places; very long texts are scanned whole; a null path has no path features; repeated documents are scanned each; an empty
table gives an empty result; findings without both labels raise ValueError; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import materialise, text_of

_KEY = r"A-Za-z0-9_\-+/."
#: Names of values that are secret, as they end before the sign.
_NAMED = r"(?i:passw(?:or)?d|passphrase|pwd|secret|token|api[_\-]?key|access[_\-]?key|private[_\-]?key|auth|bearer|credential)"
_NAME_AND_SIGN = rf"{_NAMED}[\"']?\s{{0,3}}[:=]\s{{0,3}}[\"']?"
_AFTER_NAME = r"[^\s\"',;:=<>(){}\[\]]{8,}+"
#: How keys of well-known providers begin. Fixed values.
_PROVIDED = r"(?:AKIA|ASIA|AIza|ghp_|gho_|glpat-|xox[abp]-|sk_live_|rk_live_|sk-|SG\.|eyJ)"
_WITH_DIGIT = rf"(?=[A-Za-z_\-+/.]*+[0-9])[{_KEY}]{{16,}}+={{0,2}}"
#: The candidate is group 2 or 3; group 1, a name and a sign, belongs to what precedes it.
CANDIDATE = rf"({_NAME_AND_SIGN})({_AFTER_NAME})|(?<![{_KEY}])({_PROVIDED}[{_KEY}]{{12,}}+={{0,2}}|{_WITH_DIGIT})"
#: Words before a value that speak for a key, and against one.
NAMES = r"(?i)(token|secret|passw(or)?d|passphrase|pwd|api[_-]?key|access[_-]?key|auth|bearer|credential|private)"
DIGESTS = r"(?i)(commit|sha-?\d*|md5|digest|checksum|hash|integrity|etag|revision|uuid|build)"
PATHS = r"(?i)(test|example|sample|fixture|mock|doc)"
FEATURES = (
    "length", "digits", "lowers", "uppers", "hex", "distinct", "transitions", "vowel_pairs", "covered", "path_test",
    "named", "digest", "assigned", "quoted", "dots", "provider",
)
CONTEXT = 48
#: Documents that a word stands in for its letters to count as language.
MIN_DOCS = 5
#: A private-use character that marks where texts are cut; one in a text counts as a blank.
_CUT = "\ue000"


def candidates(docs: DataFrame, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    """(row, id, path, value, start, places, before, after): distinct candidates of each text; row tells documents apart."""
    text = F.translate(text_of(text_col), _CUT, " ")
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), path.alias("path"), text.alias("text")).filter(F.col("text").rlike(CANDIDATE))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    # pieces are in turn what is between candidates and a candidate
    pieces = F.split(F.regexp_replace("text", CANDIDATE, f"$1{_CUT}$2$3{_CUT}"), _CUT, -1)
    piece = lambda i: F.coalesce(F.get("pieces", i), F.lit(""))
    every = F.transform(
        F.sequence(F.lit(0), F.size("pieces") - 1),
        lambda i: F.struct(
            i.alias("i"),
            F.length(piece(i)).cast("long").alias("size"),
            F.when(i % 2 == 1, F.struct(
                piece(i).alias("value"),
                F.right(F.concat(F.right(piece(i - 2), F.lit(CONTEXT)), piece(i - 1)), F.lit(CONTEXT)).alias("before"),
                F.substring(piece(i + 1), 1, 4).alias("after"),
            )).alias("c"),
        ),
    )
    rows = rows.select("row", "id", "path", pieces.alias("pieces")).select("row", "id", "path", F.explode(every).alias("x"))
    lengths = rows.select("row", F.col("id").alias("id"), "path", "x.*")
    from_start = F.expr("sum(size) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    placed = lengths.withColumn("start", F.coalesce(from_start, F.lit(0))).filter("c IS NOT NULL")
    first = F.min(F.struct("start", "c.before", "c.after")).alias("f")
    found = placed.groupBy("row", F.col("c.value").alias("value")).agg(
        F.any_value("id").alias("id"), F.any_value("path").alias("path"), F.count("*").alias("places"), first
    )
    return found.select("row", "id", "path", "value", "places", "f.*")


def _grams(text: Column) -> Column:
    """Distinct runs of four letters."""
    n = F.length(text)
    each = F.transform(F.sequence(F.lit(1), F.greatest(n - 3, F.lit(1))), lambda i: F.substring(text, i, F.lit(4)))
    return F.array_distinct(F.filter(each, lambda g: g.rlike("^[a-z]{4}$")))


def language_grams(docs: DataFrame, text_col: str, min_docs: int = MIN_DOCS) -> DataFrame:
    """(gram): runs of four letters (26^4 at most) in words that at least `min_docs` documents have."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text_of(text_col)), F.lit("[a-z]{4,16}+"), F.lit(0)))
    often = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs)
    return often.select(F.explode(_grams(F.col("word"))).alias("gram")).distinct()


def with_coverage(found: DataFrame, language: DataFrame) -> DataFrame:
    """found with `covered`. found: (value, ..)."""
    values = found.select("value").distinct()
    each = values.select("value", F.explode(_grams(F.lower("value"))).alias("gram"))
    met = each.join(language.withColumn("known", F.lit(1.0)), "gram", "left")
    shares = met.groupBy("value").agg((F.count("known") / F.count("*")).alias("covered"))
    return found.join(shares, "value", "left").withColumn("covered", F.coalesce("covered", F.lit(0.0)))


def with_features(found: DataFrame) -> DataFrame:
    """found with FEATURES. found: (path, value, before, covered, ..)."""
    v, n = F.col("value"), F.length("value").cast("double")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    near = F.regexp_extract("before", r"((?:\S+\s+)?\S*\W*)$", 1)
    return found.withColumns(
        {
            "length": F.least(n, F.lit(200.0)),
            "digits": share("[0-9]"),
            "lowers": share("[a-z]"),
            "uppers": share("[A-Z]"),
            "hex": v.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
            "distinct": F.size(F.array_distinct(F.split(v, ""))) / n,
            "transitions": share("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])"),
            "vowel_pairs": share("(?i)[aeiou][bcdfghjklmnpqrstvwxyz]"),
            "path_test": F.coalesce(F.col("path").rlike(PATHS), F.lit(False)).cast("double"),
            "named": near.rlike(NAMES).cast("double"),
            "digest": near.rlike(DIGESTS).cast("double"),
            "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double"),
            "quoted": F.col("before").rlike("[\"']$").cast("double"),
            "dots": share(r"[.@]"),
            "provider": v.rlike("^" + _PROVIDED).cast("double"),
        }
    )


def _made(words: str, salt: Column) -> list[tuple[Column, str, int]]:
    """(value, what stands before it, label): keys and look-alikes, different for each salt."""
    key = lambda tag: F.sha1(F.concat(F.lit(tag), salt).cast("binary"))

    def base(tag: str, n: int = 32) -> Column:
        whole = F.base64(F.unhex(F.sha2(F.concat(F.lit(tag), salt).cast("binary"), 256)))
        return F.substring(F.translate(F.regexp_replace(whole, r"\s", ""), "=", "a"), 1, n)

    word = lambda i: F.coalesce(F.nullif(F.get(words, F.lit(i)), F.lit("")), F.lit("word"))
    url = F.concat(F.lit("/"), word(7), F.lit("/"), word(8), F.lit("/page_17.html"))
    aws = lambda tag: F.concat(F.lit("AKIA"), F.translate(F.upper(F.substring(key(tag), 3, 16)), "0189", "QXYZ"))
    return [
        (key("a"), ' token = "', 1), (base("b"), ' api_key: "', 1), (aws("c"), " secret=", 1), (aws("h"), " ", 1),
        (F.concat(F.lit("ghp_"), base("i", 36)), " ", 1), (key("d"), ' password = "', 1), (base("e"), " Authorization: Bearer ", 1),
        (base("j", 40), " AWS_SECRET_ACCESS_KEY=", 1), (base("p", 12), ' password="', 1), (base("q", 10), " pwd=", 1),
        (F.concat(F.initcap(word(1)), F.initcap(word(2)), F.substring(key("r"), 1, 2), F.lit("!")), ' password = "', 1),
        (key("f"), " commit ", 0), (key("g"), ' "sha1": "', 0), (F.md5(F.concat(F.lit("m"), salt).cast("binary")), " md5 ", 0),
        (F.concat(word(3), F.lit("-"), word(4), F.lit("-"), word(5), F.lit("-2024")), ' id = "', 0),
        (F.concat(word(6), F.lit("26.mail6.example.com")), " at ", 0),
        (F.concat(F.abs(F.xxhash64(salt, F.lit(1))).cast("string"), F.lit("0000")), " of ", 0),
        (url, ' href="', 0), (F.concat(word(9), F.lit("_"), word(10), F.lit("_version_2")), ' token = "', 0),
        (F.concat(F.lit("get_"), word(2), F.lit("_"), word(4)), " password = ", 0), (F.concat(F.lit("the-"), word(5), word(6)), " token: ", 0),
        (F.lit("changeme_changeme"), ' password = "', 0), (F.concat(F.lit("your-"), word(1), F.lit("-here-123")), ' api_key = "', 0),
    ]


def derived_findings(docs: DataFrame, rows: int = 400, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(path, value, before, after, label) from `rows` documents, those with the lowest hash of their text: eight sets of made
    findings from each of 50, so that one document is enough to learn from, and own candidates of all."""
    text = text_of(text_col)
    some = docs.select(id_col, text_col, *([path_col] if path_col else [])).withColumn("_rank", F.xxhash64(F.lit(5), text))
    some = materialise(some.orderBy("_rank").limit(rows), "finding-texts")
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    lead = F.substring(F.translate(text, _CUT, " "), 60, CONTEXT - 12)
    words = F.split(F.trim(F.regexp_replace(F.substring(text, 1, 400), "[^A-Za-z]+", " ")), " ")
    base = some.orderBy("_rank").limit(50).select(
        path.alias("path"), lead.alias("lead"), words.alias("words"), F.col("_rank").cast("string").alias("r"),
        F.explode(F.sequence(F.lit(1), F.lit(8))).alias("k")
    )
    base = base.withColumn("salt", F.concat("r", F.lit(":"), F.col("k").cast("string")))
    each = [
        F.struct(v.alias("value"), F.concat("lead", F.lit(b)).alias("before"), F.lit('" ').alias("after"), F.lit(y).alias("label")) for v,
        b, y in _made("words", F.col("salt"))
    ]
    made = base.select("path", F.explode(F.array(*each)).alias("x")).select("path", "x.*")
    own = candidates(some, id_col, text_col, path_col)
    doubtful = F.col("before").rlike(NAMES) | F.col("value").rlike("^" + _PROVIDED)
    own = own.filter(~doubtful).select("path", "value", "before", "after", F.lit(0).alias("label"))
    return made.unionByName(own)


def _features(found: DataFrame, language: DataFrame) -> DataFrame:
    made = with_features(with_coverage(found, language))
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(made)


def train_forest(findings: DataFrame, language: DataFrame, trees: int = 24, depth: int = 7, seed: int = 3):
    """A forest from labelled findings: path, value, before, after, label (1: secret). language: as language_grams."""
    table = _features(findings, language).select("features", F.col("label").cast("double").alias("label"))
    table = materialise(table, "findings")
    kinds = {r["label"] for r in table.select("label").distinct().collect()}
    if not {0.0, 1.0} <= kinds:
        raise ValueError("findings need labels of both kinds")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8).fit(table)


def scan_secrets(
    docs: DataFrame, model, language: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
    path_col: str | None = "source"
) -> DataFrame:
    """(id, start, length, places, value_sha1, score) of candidates whose score reaches the threshold; start counts
    code points from 0, and the value itself isn't repeated."""
    found = _features(candidates(docs, id_col, text_col, path_col), language)
    scored = model.transform(found).withColumn("score", vector_to_array("probability")[1])
    return scored.filter(F.col("score") >= threshold).select(
        F.col("id").alias(id_col), "start", F.length("value").cast("long").alias("length"), "places",
        F.sha1(F.col("value").cast("binary")).alias("value_sha1"), "score",
    )


def scan_corpus(docs: DataFrame, findings: DataFrame | None = None, **columns) -> DataFrame:
    """Train on the findings (or on derived ones) and scan."""
    language = materialise(language_grams(docs, columns.get("text_col", "text")), "language")
    if findings is None:
        findings = derived_findings(docs, **columns)
        if docs.isEmpty():  # nothing to learn from, nor to scan
            return docs.sparkSession.createDataFrame(
                [],
                f"{columns.get('id_col', 'doc_id')} {docs.schema[columns.get('id_col', 'doc_id')].dataType.simpleString()}, start long, length long, places long, value_sha1 string, score double"
            )
    return scan_secrets(docs, train_forest(findings, language), language, **columns)
