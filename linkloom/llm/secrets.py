"""Secrets in texts: candidates by pattern, false ones removed by a random forest, all in built-in functions.

Candidates are long runs with digits, values given to names like ``password``, and key headers. Their length,
character transitions, dictionary coverage, path and neighbouring words are columns. A forest trained on
labelled findings is compiled into one SQL expression over these columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.llm.common import named
from linkloom.session import settle

_RUN = r"[A-Za-z0-9+/_=-]"
_NAME = r"(?:[Pp]ass(?:word|wd)?|PASS(?:WORD|WD)?|[Pp]wd|PWD|[Ss]ecret|SECRET|[Tt]oken|TOKEN|[Kk]ey|KEY|[Aa]uth|AUTH)"
#: A run of sixteen and more with a digit in it; what is given to a telling name; the header of a private key.
LONG_RUN = rf"(?<!{_RUN})(?=[A-Za-z+/_=-]*[0-9]){_RUN}{{16,}}"
GIVEN = rf"""(?<={_NAME}["']?\s{{0,3}}[:=]\s{{0,3}}["']?)[^\s"'<>,;:=]{{8,}}"""
HEADER = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"
_CANDIDATE = rf"(?:{HEADER}|{LONG_RUN}|{GIVEN})"
_ANY = rf"""{LONG_RUN}|{_NAME}["']?\s{{0,3}}[:=]|{HEADER}"""
# each match begins where the last one ended (\G), so the end of a text without candidates is gone over once
_FOUND = rf"(?s)\G(.*?)({_CANDIDATE})(?=(.{{0,24}}))"
BEFORE = 48   # characters kept of what stands before

#: Words of identifiers, placeholders and prose that random keys do not have.
DICTIONARY = (
    "about abc access account admin api app apple application array article author auth base book build cache chapter class client code color company config content "
    "copy count create data database date default delete demo description device document domain email end error event example fake field file first folder "
    "foo format form function group handler header here home host html http image index info insert item json key label language large last level library line link "
    "list local login long main manager message method model module month name network new number object option order page param password path photo place "
    "placeholder plugin point port post product project public query random read record report request response result root sample screen secret section select "
    "server service session setting size small source start state status string style system table tag target temp template test text thumb time title token "
    "tree type update upload url user utf value version video view web width window word work xml year your"
).split()

FEATURES = [
    "length", "digits", "uppers", "lowers", "others", "transitions", "distinct", "repeats", "covered", "hex", "vowels", "bigrams",
    "test_path", "telling_name", "placeholder_near", "given", "quoted", "harmless_name", "known_form",
]


def candidates(df: DataFrame, text_column: str = "text", path_column: str | None = "source", carry: dict[str, Column] | None = None) -> DataFrame:
    """One row for each candidate: ``carried``, ``path``, ``start``, ``stop`` (code points), ``candidate``, ``before``, ``after``.

    Candidates do not overlap and come from the left. Texts that have none are dropped by one pass of a
    pattern; only candidates with the characters around them are shuffled, to place them in their text.
    """
    carry = carry or {}
    text = named(text_column).cast("string")
    path = named(path_column).cast("string") if path_column and path_column in df.columns else F.lit(None).cast("string")
    rows = df.select(
        F.struct(F.lit(0).alias("_"), *[v.alias(k) for k, v in carry.items()]).alias("carried"), F.coalesce(path, F.lit("")).alias("path"), text.alias("text"))
    rows = rows.where(F.col("text").rlike(_ANY)).withColumn("row", F.monotonically_increasing_id())
    groups = [F.regexp_extract_all("text", F.lit(_FOUND), F.lit(k)).alias(name) for k, name in ((1, "before"), (2, "candidate"), (3, "after"))]
    found = rows.select("row", "carried", "path", F.posexplode(F.arrays_zip(*groups))).select(
        "row", "carried", "path", "pos", "col.candidate", "col.after", F.substring("col.before", -BEFORE, BEFORE).alias("before"),
        F.length("col.before").cast("long").alias("_between"), F.length("col.candidate").cast("long").alias("_length"))
    so_far = Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("_between") + F.col("_length")).over(so_far)
    return found.select("carried", "path", stop.alias("stop"), "_length", "candidate", "before", "after").withColumn(
        "start", F.col("stop") - F.col("_length")).drop("_length")


def _count(column: str, pattern: str) -> Column:
    return F.regexp_count(column, F.lit(pattern)).cast("double")


def _says(column: Column, pattern: str) -> Column:
    return column.rlike(pattern).cast("double")


def features(found: DataFrame) -> DataFrame:
    """The columns of ``FEATURES`` beside those of ``candidates``; shares are of the candidate's length."""
    n = F.length("candidate").cast("double")
    lower = F.lower("candidate")
    longest_first = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    near = F.concat(F.lower("before"), F.lit(" "), F.lower("after"))
    changes = r"[a-z](?=[^a-z])|[A-Z](?=[^A-Za-z])|[0-9](?=[^0-9])|[a-z](?=[A-Z])"
    made = {
        "length": n,
        "digits": _count("candidate", "[0-9]") / n,
        "uppers": _count("candidate", "[A-Z]") / n,
        "lowers": _count("candidate", "[a-z]") / n,
        "others": _count("candidate", "[^A-Za-z0-9]") / n,
        "transitions": _count("candidate", changes) / n,
        "distinct": F.size(F.array_distinct(F.split("candidate", ""))).cast("double") / n,
        "repeats": _count("candidate", r"(.)(?=\1)") / n,
        "covered": (n - F.length(F.regexp_replace(lower, longest_first, ""))) / n,
        "hex": _says(F.col("candidate"), "^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "vowels": _count("candidate", "[aeiouAEIOU]") / n,
        "bigrams": F.regexp_count(lower, F.lit("(?=th|he|in|er|an|re|on|en|at|es|or|te|ti|st|ar|nd|to|it|is|al)")).cast("double") / n,
        "test_path": _says(F.lower("path"), "test|example|sample|fixture|demo|mock|docs?(?:/|$)"),
        "telling_name": _says(F.lower("before"), "(?:pass|pwd|secret|token|key|auth|bearer|credential)[^\\n]{0,16}$"),
        "placeholder_near": _says(near, "example|sample|dummy|placeholder|fake|your[_-]|changeme|\\btest"),
        "given": _says(F.col("before"), "[:=]\\s{0,3}[\"']?$"),
        "quoted": _says(F.col("before"), "[\"']$") * _says(F.col("after"), "^[\"']"),
        "harmless_name": _says(F.lower("before"), "(?:commit|sha-?[0-9]*|hash|checksum|md5|uuid|guid|digest|revision|version|build|isbn|etag|base64,|https?://\\S*)[^\\n]{0,6}$"),
        "known_form": _says(F.col("candidate"), "^(?:AKIA[0-9A-Z]{16}$|gh[pousr]_|xox[abprs]-|sk[_-]|eyJ|-----BEGIN)"),
    }
    return found.select("*", *[made[name].alias(name) for name in FEATURES])


def labelled_findings(spark: SparkSession, rows: int = 2400) -> DataFrame:
    """Labelled findings to train on where no others are given: the forms secrets have, and those of what is taken for one.

    Every string comes from a digest of the row's number, so they are the same everywhere.
    """
    n = F.col("id").cast("string")
    hexes = F.sha1(n.cast("binary"))
    base64 = F.regexp_replace(F.base64(F.unhex(F.sha2(n, 256))), "[=]", "")
    plain = F.regexp_replace(base64, "[+/]", "q")
    at = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(10 ** 6)).cast("int")
    one_of = lambda words, salt: F.element_at(F.array(*map(F.lit, words)), at(salt) % len(words) + 1)
    digits = F.lpad(F.abs(F.xxhash64("id", F.lit("d"))).cast("string"), 18, "7")
    two = F.concat_ws("_", one_of(DICTIONARY, "a"), one_of(DICTIONARY, "b"), one_of(DICTIONARY, "c"), (at("e") % 1000).cast("string"))
    uuid = F.regexp_replace(F.substring(hexes, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    name = one_of(["token", "api_key", "secret", "access_token", "auth", "password", "SECRET_KEY", "client_secret"], "n")
    sign = one_of([' = "', ": ", "=", ' = ', ": '"], "s")
    word = one_of(["the", "and", "of", "with", "see", "from", "leichung", "mentation", "ción", "oneres"], "w")
    cases = [  # before, candidate, path, label
        (F.concat(name, sign), hexes, "src/main", 1), (F.concat(name, sign), base64, "src/main", 1),
        (F.concat(name, sign), F.substring(plain, 1, 24), "conf", 1), (F.concat(name, sign), F.substring(plain, 3, 12), "conf", 1),
        (word, F.concat(F.lit("AKIA"), F.upper(F.substring(hexes, 1, 16))), "notes", 1), (word, F.concat(F.lit("ghp_"), F.substring(plain, 1, 36)), "notes", 1),
        (F.lit("Authorization: Bearer "), base64, "log", 1), (F.concat(word, F.lit(" token = \"")), hexes, "", 1),
        (F.concat(one_of(["commit ", "sha1: ", "revision ", "md5 ", "checksum: ", "etag "], "h"), F.lit("")), hexes, "src", 0),
        (F.concat(one_of(["sha256:", "digest sha256 ", "hash="], "h")), F.sha2(n, 256), "src", 0),
        (F.concat(word, one_of([" id ", " uuid ", " = "], "u")), uuid, "src", 0), (F.concat(name, sign), two, "src", 0),
        (F.concat(name, sign), F.concat(F.lit("your_"), two), "src", 0), (F.concat(name, sign), F.concat(F.repeat(F.lit("x"), 18), (at("x") % 10).cast("string")), "src", 0),
        (F.concat(word, F.lit(" ")), F.concat(one_of(DICTIONARY, "a"), (at("f") % 100).cast("string"), one_of(DICTIONARY, "b"), one_of(DICTIONARY, "c"), one_of(DICTIONARY, "d")), "", 0),
        (F.concat(word, F.lit(" ")), digits, "", 0), (F.lit("src=\"data:image/png;base64,"), base64, "page", 0), (F.concat(name, sign), hexes, "tests/fixtures", 0),
        (F.concat(word, F.lit(" https://host.test/")), F.concat_ws("/", one_of(DICTIONARY, "a"), one_of(DICTIONARY, "b"), (at("g") % 3000).cast("string")), "", 0),
        (F.concat(F.lit("example "), name, sign), hexes, "docs/guide", 0), (F.concat(word, F.lit(" ")), hexes, "", 0),
    ]
    pick = at("case") % len(cases)
    chosen = lambda k: reduce(lambda other, c: F.when(pick == c, F.lit(cases[c][k]) if not isinstance(cases[c][k], Column) else cases[c][k]).otherwise(other),
                              range(len(cases)), F.lit(None))
    made = spark.range(0, rows, 1, 4).select(
        F.concat(word, F.lit(" "), chosen(0).cast("string")).alias("before"), chosen(1).cast("string").alias("candidate"), chosen(2).cast("string").alias("path"),
        chosen(3).cast("double").alias("label"))
    made = settle(made, "labelled-findings")
    return made.withColumn("after", F.when(F.col("before").endswith('"'), '" and').when(F.col("before").endswith("'"), "' so").otherwise(F.lit(" then")))


class Forest:
    """A random forest as an expression: the mean of its trees' leaves."""

    def __init__(self, trees: list):
        self.trees = trees  # leaf: a float; else (feature, threshold, tree if at most, tree if more)

    @staticmethod
    def fit(labelled: DataFrame, trees: int = 25, depth: int = 7, seed: int = 7, most_rows: int = 20_000) -> Forest:
        """Train on labelled findings with the columns of ``features`` and ``label``; at most ``most_rows``, by least hash."""
        from pyspark.ml.classification import RandomForestClassifier
        from pyspark.ml.feature import VectorAssembler

        rows = settle(labelled.select(*FEATURES, "label").orderBy(F.xxhash64(*FEATURES, "label")).limit(most_rows), "findings")
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(rows)
        model = RandomForestClassifier(
            featuresCol="vector", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=3).fit(vectors)
        return Forest([_tree(t._java_obj.rootNode()) for t in model.trees])

    def score(self) -> Column:
        total = reduce(lambda a, b: a + b, map(_expression, self.trees), F.lit(0.0))
        return total / F.lit(float(len(self.trees)))


def _tree(node) -> object:
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return FEATURES[split.featureIndex()], float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def _expression(tree) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    name, threshold, low, high = tree
    return F.when(F.col(name) <= F.lit(threshold), _expression(low)).otherwise(_expression(high))


def scan(df: DataFrame, forest: Forest, text_column: str = "text", path_column: str | None = "source", carry: dict[str, Column] | None = None,
         threshold: float = 0.5) -> DataFrame:
    """One row for each candidate: what ``carry`` names, ``start``, ``stop``, ``kind``, ``candidate``, ``score``, ``is_secret``.

    Positions are code points, ends exclusive. Null and empty texts have no candidate; a missing path is
    an empty one; equal rows give equal findings. A candidate whose votes are even counts as a secret.
    """
    found = features(candidates(df, text_column, path_column, carry))
    candidate = F.col("candidate")
    kind = (
        F.when(candidate.startswith("-----BEGIN"), "private_key").when(candidate.rlike("^AKIA[0-9A-Z]{16}$"), "aws").when(candidate.rlike("^gh[pousr]_"), "github")
        .when(candidate.rlike("^xox[abprs]-"), "slack").when(candidate.rlike("^eyJ"), "jwt").when(F.col("telling_name") > 0, "named")
        .when(F.col("hex") > 0, "hex").otherwise("run"))
    return found.withColumn("score", forest.score()).select(
        *[F.col(f"carried.{k}").alias(k) for k in (carry or {})], "start", "stop", kind.alias("kind"), "candidate", "score",
        (F.col("score") >= threshold).alias("is_secret"))
