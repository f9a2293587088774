"""Secret scans: candidate strings, and a random forest that removes the false ones.

The forest is trained by pyspark.ml on labelled findings and then written out as one SQL expression, so texts are
scanned, scored and redacted row by row in the JVM: no join, no shuffle, nothing but built-in functions.
"""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingloom.llm.common import positions, taken

# What a candidate looks like, and the words looked for in and around it.
VALUE = r"[A-Za-z0-9+/_-]{16,}+={0,2}"
#: A secret-like name: one of these words, whole, or as the last or first part of a name by _ . - or a change of case.
WORDS = "[a-z]{0,8}passw(?:or)?d|pwd|passphrase|secret|token|api_?key|access_?key|api|key|auth|credentials?|bearer|private"
NAME = rf"(?:(?<![A-Za-z])(?i:{WORDS})(?![a-z]|(?<=[A-Z])[A-Z])|(?<=[a-z])(?:Passw(?:or)?d|Secret|Token|Key|Auth|Credentials?)(?![a-z]))"
#: What a value goes on with: up to a blank, quote or next parameter, without final stops; six characters at least.
TAIL = r"(?=[^\s\"'`<>]{6})(?:[^\s\"'`<>&,;.:)\]}]++|[,;.:)\]}]++(?=[^\s\"'`<>&])|&(?!\w+=)(?=[^\s\"'`<>&]))++"
#: What is given to such a name, quoted or not; what a text says that it is; what stands for the password in an address.
#: Lookbehinds are bounded, the cheap one comes first.
GIVEN = (
    rf"(?<=[=:]>?[ \t]{{0,8}}[\"'`]?)(?<={NAME}[A-Za-z0-9_.-]{{0,24}}[\"'`]?[ \t]{{0,8}}[=:]{{1,2}}>?[ \t]{{0,8}}[\"'`]?)(?![=:>]){TAIL}"
    rf"|(?<=s[ ][\"'`]?)(?<=(?i:passw(?:or)?d|pwd|passphrase|secret|token|key)[ ](?:is|was)[ ][\"'`]?){TAIL}"
    r"|(?<=:)(?<=://[A-Za-z0-9._%+-]{0,40}:)[^\s/@\"'`<>]{6,64}(?=@)"
)
KEYWORDS = NAME
HARMLESS = r"(?i)(commit|sha|md5|hash|checksum|digest|uuid|revision|version|example|order|invoice|card|phone|build|primary|foreign|public|partition|author|keyboard|keyword|sort)"
DICTIONARY = "access account address admin alpha application archive article assets background backup beta binary branch browser build button category channel client cluster code column commit component config connection container content context controller country customer data database date default delete demo detail device digest directory document domain download element email engine error event example export feature field file filter folder format function gateway generic group handler header health helper history home host image import index info input install instance interface internal invoice item language layout library license line link list local location login main manager map master media member memory message method model module month name network node number object option order output package page param parser password path payment period placeholder plugin policy port prefix process product profile project property public query queue record release remote report request resource response result route sample schema script search section secret server service session setting site size source stage start state static status storage stream string style system table target task template test text thread time title token tool type update upload user utils value version video view web width window worker your".split()  # noqa: E501, SIM905

FEATURES = ["length", "digits", "upper", "lower", "transitions", "distinct", "dictionary", "slashes", "separators", "path_before", "keyword", "assigned", "harmless", "equals", "address"]
CONTEXT, TREES, DEPTH, FINDINGS = 40, 15, 6, 6000


def features(value: Column, before: Column) -> Column:
    """FEATURES of a candidate and the text before it, as a struct of doubles."""
    n = F.length(value).cast("double")
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / n
    near = F.regexp_extract(before, r"(\S*\s+){0,3}\S*$", 0)
    known = F.length(F.regexp_replace(F.lower(value), "|".join(DICTIONARY), ""))
    return F.struct(
        n.alias("length"), share("[0-9]").alias("digits"), share("[A-Z]").alias("upper"), share("[a-z]").alias("lower"),
        share(r"(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]").alias("transitions"),
        (F.size(F.array_distinct(F.split(value, ""))) / n).alias("distinct"),
        (1 - known / n).alias("dictionary"),
        F.regexp_count(value, F.lit("/")).cast("double").alias("slashes"), F.regexp_count(value, F.lit("[_-]")).cast("double").alias("separators"),
        before.rlike(r"[/.:@]$").cast("double").alias("path_before"),
        near.rlike(KEYWORDS).cast("double").alias("keyword"),
        before.rlike(r"([=:]|\b(is|was))\s*[\"'`]?$").cast("double").alias("assigned"),
        near.rlike(HARMLESS).cast("double").alias("harmless"),
        before.rlike(r"(=>?\s*|[\"'`])$").cast("double").alias("equals"),
        before.rlike(r"://[^\s/@]*:$").cast("double").alias("address"),
    )


def labelled_findings(spark: SparkSession, n: int = FINDINGS) -> DataFrame:
    """n labelled findings (id, maker, before, value, label) drawn by hashes: keys of common make, and the strings mistaken for
    them. Makers are independent ways of making a finding, so that some can be held out whole."""
    i = F.col("id")
    hexed = lambda k, salt: F.substring(F.sha2(F.concat(i.cast("string"), F.lit(salt)), 512), F.lit(1), k)
    base64 = F.regexp_replace(F.base64(F.unhex(hexed(F.lit(64), "b"))), "=+$", "")
    upper = F.upper(F.regexp_replace(base64, "[+/]", "Q"))
    pick = lambda words, salt: F.get(F.array(*map(F.lit, words)), F.pmod(F.xxhash64(F.lit(salt), i), F.lit(len(words))).cast("int"))
    some = lambda salt: pick(DICTIONARY, salt)
    size = (16 + F.pmod(F.xxhash64(F.lit("n"), i), F.lit(34))).cast("int")
    prose = F.concat(some("x"), F.lit(" "), some("y"), F.lit(" "))
    name = pick(["password", "passwd", "api_key", "token", "secret", "auth_token", "private_key", "client_secret"], "k")
    gives = pick(["=", " = \"", ": ", ": \"", "='", ":"], "g")
    assign = F.concat(prose, name, gives)
    digits = F.regexp_replace(hexed(F.lit(100), "d"), "[a-f]", "")
    dashed = F.concat_ws("-", hexed(F.lit(8), "u"), hexed(F.lit(4), "v"), hexed(F.lit(4), "w"), hexed(F.lit(4), "x"), hexed(F.lit(12), "y"))
    letters = F.translate(base64, "0123456789+/", "qWzXvKjYpRtB")
    short = (6 + F.pmod(F.xxhash64(F.lit("s"), i), F.lit(7))).cast("int")
    mark = pick(["!", "@", "#", "$", ".", "%", "*"], "m")
    phrase = lambda salt: pick(["correct", "horse", "battery", "staple", "purple", "monkey", "tractor", "velvet", "sunny", "river", "dragon", "pepper"], salt)
    stem = lambda salt: F.concat(pick(["under", "with", "over", "some", "nobody", "every", "through", "inter", "mean", "south", "verantwort"], salt + "1"), pick(["stand", "thing", "whelm", "where", "ward", "body", "holden", "national", "lich", "keit", "respons"], salt + "2"), pick(["", "ing", "s", "ation", "heiten", "ungs"], salt + "3"))
    plain = F.when(i % 3 == 0, F.initcap(stem("v"))).otherwise(stem("v"))
    long = F.concat(plain, stem("w"))
    told = F.concat(prose, pick(["the key", "a secret", "token", "authors", "private", "password", "keywords"], "t"), F.lit(": "))
    address = F.concat(prose, pick(["postgres", "mysql", "https", "redis", "amqp"], "q"), F.lit("://"), some("u"), F.lit(":"))
    said = F.concat(prose, pick(["the password is ", "my passphrase is ", "the token was ", "Your secret is \"", "the key is '"], "z"))
    other = F.concat(prose, pick(["primary_key", "foreign_key", "public_key", "partition_key", "sort_key", "author", "keyboard"], "j"), gives)
    firmly = F.concat(prose, name, pick(["=", " = \"", "='", ": \""], "f"))
    kinds = [
        (assign, hexed(size, "a"), 1), (assign, F.substring(base64, F.lit(1), size), 1), (prose, F.concat(F.lit("AKIA"), F.substring(upper, 1, 16)), 1),
        (prose, F.concat(pick(["ghp_", "sk-live-", "xoxb-", "glpat-"], "p"), F.substring(F.regexp_replace(base64, "[+/]", "z"), 1, 36)), 1),
        (F.concat(prose, name, F.lit(" ")), F.substring(base64, F.lit(1), size), 1), (assign, F.concat(F.lit("AKIA"), F.substring(upper, 1, 16)), 1),
        (prose, F.substring(digits, F.lit(1), F.least(size, F.lit(20))), 0), (F.concat(prose, pick(["commit ", "sha256:", "sha1 ", "md5=", "digest ", "checksum: ", "build "], "h")), hexed(size, "c"), 0),
        (prose, dashed, 0), (F.concat(prose, pick(["uuid=", "order: ", "id=", "version = "], "o")), dashed, 0),
        (prose, F.concat_ws("_", some("1"), some("2"), some("3"), F.substring(digits, 1, 2)), 0), (F.concat(prose, F.lit("https://host/")), F.concat_ws("/", some("4"), some("5"), F.substring(digits, 1, 4), some("6")), 0),
        (assign, F.concat_ws("_", F.lit("your"), some("7"), some("8"), F.lit("here1")), 0), (assign, F.concat(F.repeat(pick(["x", "0", "1", "a"], "r"), 18), F.lit("1")), 0), (prose, F.concat(some("9"), some("0"), some("11"), F.substring(digits, 1, 4)), 0),
        (F.concat(prose, F.lit("/")), F.concat_ws("-", some("12"), some("13"), F.substring(digits, 1, 8)), 0),
        (assign, hexed(F.lit(12) + i % 4, "e"), 1), (assign, F.concat(F.substring(base64, F.lit(1), short), mark, F.substring(base64, 30, 3)), 1),
        (assign, F.concat(phrase("p0"), mark, F.substring(digits, 1, 4), mark), 1), (firmly, F.concat_ws("-", phrase("p1"), phrase("p2"), phrase("p3"), phrase("p4")), 1),
        (assign, F.substring(letters, F.lit(1), size), 1), (firmly, F.lower(F.substring(letters, F.lit(1), short + 8)), 1),
        (prose, F.concat(F.lit("AKIA"), F.upper(F.substring(letters, 1, 16))), 1),
        (told, plain, 0), (assign, some("13"), 0), (assign, F.concat_ws(".", some("14"), F.concat(some("15"), F.lit("("))), 0),
        (assign, F.concat(F.lit("${"), F.upper(some("16")), F.lit("_"), F.upper(some("17"))), 0), (assign, F.repeat(pick(["*", "x", ".", "#"], "r2"), 10), 0),
        (prose, F.concat(plain, F.lower(some("18")), plain), 0), (prose, F.repeat(pick(["-", "_", "+", "/", "a"], "r3"), 24), 0),
        (prose, long, 0), (told, long, 0), (prose, F.concat(long, stem("y")), 0), (prose, F.upper(long), 0), (prose, F.concat_ws("-", plain, some("19"), plain), 0), (prose, F.concat(some("20"), F.initcap(some("21")), F.initcap(some("22"))), 0), (assign, F.lit("[SECRET"), 0),
        (address, F.concat(phrase("p5"), F.substring(digits, 1, 3)), 1), (address, F.substring(base64, F.lit(1), short + 4), 1), (said, F.concat(F.initcap(phrase("p6")), F.substring(digits, 1, 2), mark), 1), (said, F.substring(base64, F.lit(1), size), 1),
        (said, pick(["required", "incorrect", "missing", "invalid", "stored", "changed", "optional", "expired", "encrypted", "correct", "wrong,", "needed"], "w"), 0), (F.concat(said, F.lit("")), plain, 0),
        (other, dashed, 0), (other, F.concat_ws("_", some("23"), some("24")), 0), (other, hexed(F.lit(12) + i % 8, "z"), 0), (other, F.concat(some("25"), F.substring(digits, 1, 4)), 0),
    ]
    turn = F.pmod(i, F.lit(len(kinds)))
    each = F.array(*(F.struct(b.alias("before"), v.alias("value"), F.lit(float(y)).alias("label")) for b, v, y in kinds))
    return spark.range(0, n, 1, 1).select("id", turn.cast("int").alias("maker"), F.get(each, turn.cast("int")).alias("f")).select("id", "maker", "f.*")


Node = tuple  # (feature, threshold, below or equal, above), or (share of secrets,) for a leaf


def grown(node: JavaObject) -> Node:
    """A tree of pyspark.ml as plain tuples."""
    if node.subtreeDepth() == 0:
        harmless, secret = node.impurityStats().stats()
        return (secret / (harmless + secret),)
    split = node.split()
    return (FEATURES[split.featureIndex()], split.threshold(), grown(node.leftChild()), grown(node.rightChild()))


def written(node: Node, f: Column) -> Column:
    """The expression of a tree: the share of secrets in the leaf that f falls into."""
    if len(node) == 1:
        return F.lit(float(node[0]))
    feature, threshold, low, high = node
    return F.when(f[feature] <= float(threshold), written(low, f)).otherwise(written(high, f))


class Forest:
    """Trees as tuples; vote(features) is the mean share of secrets in their leaves, by which pyspark.ml decides too."""

    def __init__(self, model: RandomForestClassificationModel):
        self.trees = [grown(tree._java_obj.rootNode()) for tree in model.trees]

    def vote(self, f: Column) -> Column:
        """f: a column or a lambda variable; as an expression it would be written out at every node."""
        total = F.lit(0.0)
        for tree in self.trees:
            total = total + written(tree, f)
        return total / len(self.trees)


def assembled(findings: DataFrame) -> DataFrame:
    """label and the features of findings as a vector."""
    rows = findings.select("label", features(F.col("value"), F.col("before")).alias("f")).select("label", "f.*")
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def fitted(findings: DataFrame) -> RandomForestClassificationModel:
    """pyspark.ml's model of labelled findings (before, value, label), whose number is bounded; its randomness is seeded and the
    rows are ordered."""
    rows = assembled(findings).repartition(1).sortWithinPartitions("label", *FEATURES)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11).fit(rows.select("label", "features"))


def train(findings: DataFrame) -> Forest:
    return Forest(fitted(findings))


def with_findings(documents: DataFrame, forest: Forest, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """documents with further columns, and their names: found (start, end, value, vote of every candidate, in code points, ends
    excluded), gaps (the text between candidates) and hits."""
    pattern = rf"(?:{GIVEN}|(?<![A-Za-z0-9+/_-]){VALUE})"
    c = dict(zip(("hits", "gaps", "at", "seen", "found"), taken(documents, "hits", "gaps", "at", "seen", "found")))
    whole, none = F.coalesce(F.col(text), F.lit("")), F.array().cast("array<string>")
    d = documents.withColumn(c["hits"], F.regexp_extract_all(whole, F.lit(f"({pattern})"), F.lit(1)))
    d = d.withColumn(c["gaps"], F.when(F.size(c["hits"]) > 0, F.split(whole, pattern, -1)).otherwise(none))
    d = d.withColumn(c["at"], positions(c["gaps"], c["hits"]))

    def before(i: Column) -> Column:
        """CONTEXT characters before candidate i, or as many as the seven candidates and gaps before it hold."""
        gap = F.get(c["gaps"], i)
        piece = lambda of, k: F.coalesce(F.get(c[of], i - k), F.lit(""))
        near = F.concat(*(piece(of, k) for k in range(7, 0, -1) for of in ("gaps", "hits")), gap)
        return F.right(F.when(F.length(gap) >= CONTEXT, gap).otherwise(near), F.lit(CONTEXT))

    d = d.withColumn(c["seen"], F.transform(c["at"], lambda p, i: features(F.get(c["hits"], i), before(i))))
    found = F.transform(c["seen"], lambda f, i: F.struct(F.get(c["at"], i)["start"].alias("start"), F.get(c["at"], i)["end"].alias("end"), F.get(c["hits"], i).alias("value"), forest.vote(f).alias("vote")))
    return d.withColumn(c["found"], found), c


def scan_secrets(documents: DataFrame, forest: Forest | None = None) -> DataFrame:
    """doc_id, n_candidates, n_secrets, secrets ("start:end,...") of every row.

    Candidates are runs of 16 or more of [A-Za-z0-9+/_-], and whatever of six or more characters is given to a secret-like name,
    said to be one, or the password of an address (GIVEN); what is neither isn't seen. A null or empty text has no candidates. Repeated rows and null ids each get
    a row, further columns take no part, an empty table gives no rows.
    """
    forest = forest or train(labelled_findings(documents.sparkSession))
    d, c = with_findings(documents.select("doc_id", "text"), forest)
    secrets = F.filter(c["found"], lambda x: x["vote"] > 0.5)
    d = d.select("doc_id", F.size(c["found"]).cast("long").alias("n_candidates"), secrets.alias("s"))
    return d.select("doc_id", "n_candidates", F.size("s").cast("long").alias("n_secrets"), F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("secrets"))


def redact_secrets(documents: DataFrame, forest: Forest | None = None) -> DataFrame:
    """documents, each secret in text replaced by [SECRET]; other columns, and texts without secrets, null and empty ones too, stay as
    they are, as do repeated rows; an empty table gives no rows."""
    forest = forest or train(labelled_findings(documents.sparkSession))
    d, c = with_findings(documents, forest)
    part = lambda x, i: F.concat(F.get(c["gaps"], i), F.when(x["vote"] > 0.5, F.lit("[SECRET]")).otherwise(x["value"]))
    whole = F.concat(F.array_join(F.transform(c["found"], part), ""), F.array_join(F.slice(c["gaps"], F.size(c["found"]) + 1, F.size(c["gaps"])), ""))
    return d.withColumn("text", F.when(F.exists(c["found"], lambda x: x["vote"] > 0.5), whole).otherwise(F.col("text"))).select(*documents.columns)
