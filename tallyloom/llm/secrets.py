"""Secret scans with a random forest that removes false positives; DataFrame and SQL functions only.

Candidates are all runs of at least twelve letters and digits, a digit among them, wherever they stand
in a word, and values of any kind that a credential word announces and assigns. Each is described by its length, its character classes and their transitions, how much of it the
corpus's own vocabulary covers, how likely its letter pairs are in that vocabulary, its path and what
its neighbouring words say. A random forest trained on labelled findings decides which candidates are
secrets. Labels come from a table, or, without one, from findings that formats and wording leave no
doubt about; the forest, which also sees these without the signs that labelled them, decides about
all others.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Distinct labelled findings that the forest is trained on, about: more are thinned, each class by its own rate.
LABELLED_FINDINGS = 20_000
#: Share of the distinct texts that a word occurs in at least to count as vocabulary, and the texts it needs in a small corpus.
VOCABULARY_SHARE, VOCABULARY_TEXTS = 1e-4, 5
#: Groups of copies above this part of the rows, fewer than its inverse, are looked up when words are counted.
_COPIES = 20_000
#: Labelled findings beside which a word stands at least to say something about others.
NEIGHBOUR_FINDINGS = 5

# Prefixes of credential formats, and words that announce a credential.
FORMATS = r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|AIza[A-Za-z0-9_-]{35}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]{20,}|eyJ[A-Za-z0-9_-]{10,}(?:\.[A-Za-z0-9_-]+)+)(?:\..*)?$"
_NAMES = r"passw|pwd|secret|token|api_?key|access_?key|private_?key|auth(?!or)|credential|bearer"
ANNOUNCED = rf"(?i){_NAMES}"

_BLANK = r"[\x20\x09-\x0D]+"
_RUN = r"[A-Za-z0-9+/_-]{12,}(?:={1,2}(?![\"'`]?[A-Za-z0-9+/_=$-]))?"
_PARTS = r"eyJ[A-Za-z0-9_-]{10,}(?:\.[A-Za-z0-9_-]+){1,4}|(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+\.[A-Za-z0-9_-]{4,}+\.[A-Za-z0-9_-]{20,}"
_KEY = rf"(?i:{_NAMES})[\w.-]{{0,40}}[\"'`\]]{{0,2}}"  # a credential word to its end
_SIGN = r"[=:]{1,3}>?[\"'`(\[{]{0,2}"
_ANY = r"[^\s\"'`,;&<>(){}\[\]\\|]+(?<![.:])"
_TOLD = rf"(?<={_KEY}{_SIGN}){_ANY}"
_USER = r"(?<=://[^\s:/@\"'`]{0,64}:)[^\s/@\"'`]+(?=@)"  # the password of an address
# The same read forward, which costs no look back at every character.
_HAS_TOLD = rf"{_KEY}{_SIGN}[^\s]"
_HAS_USER = r"://[^\s:/@\"'`]{0,64}:[^\s/@\"'`]+@"
_HINTS = ("passw", "pwd", "secret", "token", "key", "auth", "credential", "bearer")  # parts of all of _NAMES
_FIRST = rf"(?<=^[\"'`(\[{{]{{0,3}}){_ANY}"
# (text since the value before)(value), and eight characters after it. \\G: no second look at a tail without values.
_VALUES = rf"(?s)\G(.*?)({_USER}|{_TOLD}|{_PARTS}|{_RUN})(?=(.{{0,8}}))"
_VALUES_TOLD = rf"(?s)\G(.*?)({_FIRST}|{_USER}|{_TOLD}|{_PARTS}|{_RUN})(?=(.{{0,8}}))"
#: Characters kept of the text before a value: a longer key or address is read from its end.
_NEAR = 200
#: Log probability of a letter pair that the vocabulary lacks.
_RARE_PAIR = -8.0
FEATURES = [
    "length", "digits", "upper", "lower", "others", "hex", "transitions", "runs", "coverage", "pairs", "neighbours",
    "in_path", "path_test", "at_sign", "dotted", "announced", "announced_before", "assigned", "quoted", "format", "numeric",
]
#: Inputs that beyond_doubt() labels by. The forest is trained with them and, on masked copies, without.
LABELLED_BY = ["digits", "coverage", "in_path", "at_sign", "announced", "announced_before", "assigned", "format", "numeric"]


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, place, value, key, tail, before, earlier, own, user, path): candidates of every text.

    place is that of the word, which may hold several. key: the text before the value that belongs
    to it; tail: some characters after it; before, earlier: the words before, where the key is bare
    of letters. own: announced and assigned; user: the password of an address.
    """
    text = F.col("text").cast("string")
    path = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("mark"), path.alias("path"), text.alias("text"))
    whole, lower = F.col("text"), F.lower("text")
    hinted = reduce(or_, [F.contains(lower, F.lit(hint)) for hint in _HINTS]) & whole.rlike(_KEY + r"\s*[=:]|(?i:bearer)\s")
    address = F.contains(whole, F.lit("://")) & whole.rlike(_HAS_USER)
    rows = rows.filter(whole.rlike(r"(?=[A-Za-z+/_-]{0,64}[0-9])" + _RUN) | hinted | address | whole.rlike(_PARTS))
    words = F.split("text", _BLANK)
    rows = rows.select("doc_id", "mark", "path", words.alias("words"))

    def around(word, place):
        near = lambda step: F.right(F.get(F.col("words"), place + step), F.lit(_NEAR))
        return F.struct(place.alias("place"), word.alias("word"), near(-1).alias("before"), near(-2).alias("earlier"))

    def told(w):
        """The word before it announces and assigns the first value of a word."""
        sign = w["before"].rlike(rf"^{_SIGN}$|^->$") & w["earlier"].rlike(_KEY + "$")
        return F.coalesce(w["before"].rlike(rf"{_KEY}{_SIGN}$") | w["before"].rlike(r"(?i)(?:^|[\"'`=:])bearer$") | sign, F.lit(False))

    def worth(w):
        word = w["word"]
        return (word.rlike("[0-9]") & word.rlike(_RUN)) | word.rlike(_PARTS) | word.rlike(_HAS_TOLD) | word.rlike(_HAS_USER) | told(w)

    found = F.filter(F.transform("words", around), worth)
    rows = rows.select("doc_id", "mark", "path", F.explode(found).alias("w")).withColumn("told", told(F.col("w")))

    def group(i: int):
        both = [F.regexp_extract_all("w.word", F.lit(pattern), F.lit(i)) for pattern in (_VALUES_TOLD, _VALUES)]
        return F.when(F.col("told"), both[0]).otherwise(both[1])

    rows = rows.select("doc_id", "mark", "path", "told", "w.place", "w.before", "w.earlier", group(1).alias("leads"), group(2).alias("values"), group(3).alias("tails"))
    # A key may itself be a run, so the text before a value goes back over three of them.
    texts = F.transform(F.arrays_zip("leads", "values"), lambda p: F.right(F.concat(p["leads"], p["values"]), F.lit(_NEAR)))
    rows = rows.withColumn("texts", texts)

    def one(value, i):
        earlier = F.array_join(F.slice("texts", F.greatest(i - 2, F.lit(1)), F.least(i, F.lit(3))), "")
        context = F.right(F.concat(earlier, F.get(F.col("leads"), i)), F.lit(_NEAR))
        return F.struct(value.alias("value"), i.alias("i"), context.alias("context"), F.get(F.col("tails"), i).alias("tail"))

    rows = rows.select("doc_id", "mark", "path", "told", "place", "before", "earlier", F.explode(F.transform("values", one)).alias("v"))
    rows = rows.select("doc_id", "mark", "path", "told", "place", "before", "earlier", "v.*")
    key = F.regexp_extract("context", r"[^&,;{}?|\s]*$", 0)
    user = F.col("context").rlike(r"://[^\s:/@\"'`]{0,64}:$") & F.startswith(F.col("tail"), F.lit("@"))
    rows = rows.withColumn("key", key).withColumn("user", user)
    bare = ~F.col("key").rlike("[A-Za-z0-9]") & (F.col("i") == 0)
    own = F.col("key").rlike(rf"{_KEY}{_SIGN}$") | (F.col("told") & (F.col("i") == 0)) | F.col("user")
    rows = rows.withColumn("own", own).withColumns({c: F.when(bare, F.col(c)) for c in ("before", "earlier")}).drop("told", "context", "i")
    long = (F.length("value") >= 12) & F.col("value").rlike("[0-9]")
    return rows.filter(long | F.col("own") | F.col("value").rlike(FORMATS))


def vocabulary(docs: DataFrame, share: float = VOCABULARY_SHARE, least: int = VOCABULARY_TEXTS) -> DataFrame:
    """(fragment): lower-cased words of letters that occur in at least this share of the distinct texts.

    A row of a group of copies counts for its part of one text. Smaller groups than 1 / _COPIES of
    the rows could not make a word vocabulary; their rows count whole.
    """
    text = F.col("text").cast("string")
    rows = docs.select(text.alias("text"), F.xxhash64(text).alias("mark"))
    marks = stored(rows.groupBy("mark").agg(F.count("*").alias("n")), "marks")
    total = marks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("texts")).first()
    many = F.broadcast(marks.filter(F.col("n") * _COPIES > total["rows"]))  # fewer than _COPIES rows
    rows = rows.join(many, "mark", "left").withColumn("weight", 1 / F.coalesce("n", F.lit(1)))
    words = F.array_distinct(F.split(F.lower("text"), _BLANK))
    words = rows.select(F.explode(words).alias("fragment"), "weight").filter(F.col("fragment").rlike(r"^\p{L}{3,24}$"))
    needed = max(least, share * total["texts"]) - 1e-6
    return words.groupBy("fragment").agg(F.sum("weight").alias("n")).filter(F.col("n") >= needed).select("fragment")


def letter_pairs(known: DataFrame) -> DataFrame:
    """(pair, log): log probability of the second of two letters a-z after the first, in the vocabulary; 676 rows at most."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("fragment") - 1), lambda i: F.substring("fragment", i, F.lit(2)))
    pairs = known.select(F.explode(pairs).alias("pair")).filter(F.col("pair").rlike("^[a-z]{2}$")).groupBy("pair").agg(F.count("*").alias("n"))
    first = Window.partitionBy(F.substring("pair", 1, 1))
    return pairs.select("pair", F.log((F.col("n") + 0.5) / (F.sum("n").over(first) + 13)).alias("log"))


def _pair_likelihood(values: DataFrame, known: DataFrame) -> DataFrame:
    """(value, pairs): mean log probability of the letter pairs of distinct values; pairs the vocabulary lacks have a floor."""
    low = F.lower("value")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length("value") - 1, F.lit(1))), lambda i: F.substring(low, i, F.lit(2)))
    each = values.select("value", F.explode(pairs).alias("pair")).filter(F.col("pair").rlike("^[a-z]{2}$"))
    each = each.join(F.broadcast(letter_pairs(known)), "pair", "left")
    return each.groupBy("value").agg(F.avg(F.coalesce("log", F.lit(_RARE_PAIR))).alias("pairs"))


def neighbours(rows: DataFrame) -> DataFrame:
    """`rows` with `words`: the words of letters around a value, without those that announce a credential."""
    text = F.lower(F.concat_ws(" ", "key", "before", "earlier"))
    words = F.filter(F.array_distinct(F.split(text, "[^a-z]+")), lambda w: (F.length(w) >= 3) & ~w.rlike(ANNOUNCED))
    return rows.withColumn("words", words)


def with_neighbours(rows: DataFrame) -> DataFrame:
    """Rows (with label) with `neighbours`: how much the words around a value speak for a secret, on average.

    A word's weight is the logarithm of its odds among distinct labelled values, against all of them.
    A labelled row's own value does not count for it.
    """
    rows = neighbours(rows).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "neighbours")
    each = rows.select("row", "value", "label", F.explode("words").alias("word"))
    told = each.filter("label is not null").select("value", "label", "word").distinct()
    one = F.col("label")
    seen = told.groupBy("word").agg(F.sum(one).alias("ones"), F.count("*").alias("all")).filter(F.col("all") >= NEIGHBOUR_FINDINGS)
    overall = told.select("value", "label").distinct().agg(F.coalesce(F.avg("label"), F.lit(0.5))).first()[0]
    own, mine = F.coalesce(one, F.lit(0.0)), F.col("label").isNotNull().cast("double")
    ones, all_ = F.col("ones") - own, F.col("all") - mine
    odds = F.log((ones + overall) / (all_ - ones + 1 - overall)) - math.log((overall + 1e-6) / (1 - overall + 1e-6))
    weighed = each.join(seen, "word").groupBy("row").agg(F.avg(odds).alias("neighbours"))
    return rows.join(weighed, "row", "left").withColumn("neighbours", F.coalesce("neighbours", F.lit(0.0))).drop("row", "words")


def described(found: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates with their features."""
    parts = F.filter(F.split(F.lower("value"), "[^a-z]+"), lambda p: F.length(p) >= 3)
    own = found.select("value").distinct().select("value", F.explode(parts).alias("fragment")).distinct()
    covered = own.join(known, "fragment", "left_semi").groupBy("value").agg(F.sum(F.length("fragment")).alias("covered"))
    rows = found.join(covered, "value", "left").join(_pair_likelihood(found.select("value").distinct(), known), "value", "left")
    size = F.length("value")

    def share(pattern: str):
        return F.length(F.regexp_replace("value", pattern, "")) / size

    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[0-9]", "0"), "[A-Z]", "A"), "[a-z]", "a")
    runs = F.length(F.regexp_replace(shape, r"(.)\1+", "$1"))
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    key = F.col("key")
    signs = F.concat_ws(" ", key, F.col("before"))
    columns = {
        "length": size.cast("double"),
        "digits": share("[^0-9]"),
        "upper": share("[^A-Z]"),
        "lower": share("[^a-z]"),
        "others": share("[A-Za-z0-9]"),
        "hex": flag(F.col("value").rlike("^[0-9a-f]+$")),
        "transitions": (runs - 1) / size,
        "runs": runs.cast("double"),
        "coverage": F.coalesce(F.col("covered"), F.lit(0)) / size,
        "pairs": F.coalesce(F.col("pairs"), F.lit(0.0)),
        "in_path": flag(~F.col("user") & (F.concat(key, F.substring("value", 1, 2)).rlike(r"://|\\") | F.col("tail").rlike(r"^\.[A-Za-z]{1,5}(?![A-Za-z0-9])"))),
        "path_test": flag(F.col("path").rlike(r"(?i)test|example|sample|fixture")),
        "at_sign": flag(~F.col("user") & (key.contains("@") | F.startswith(F.col("tail"), F.lit("@")))),
        "dotted": flag(key.rlike(r"\w\.$") | F.col("tail").rlike(r"^\.\w")),
        "announced": flag(key.rlike(ANNOUNCED) | F.col("own")),
        "announced_before": flag(F.concat_ws(" ", "before", "earlier").rlike(ANNOUNCED)),
        "assigned": flag(signs.rlike("[=:]") | F.col("own")),
        "quoted": flag(key.rlike("[\"'`]")),
        "format": flag(F.col("value").rlike(FORMATS)),
        "numeric": flag(F.col("value").rlike("^[0-9-]+$")),
    }
    return rows.withColumns(columns).drop("covered")


def beyond_doubt():
    """1 for a credential format or an announced, assigned value; 0 for numbers, addresses, paths and vocabulary; else null.

    The signs of paths and addresses are around a value: slashes inside it say nothing. Where a
    credential word announces what else looks harmless, the signs conflict: null, but 0 for plain vocabulary.
    """
    told = (F.col("announced") + F.col("announced_before") > 0) & (F.col("assigned") == 1)
    plain = (F.col("coverage") >= 0.8) & (F.col("digits") == 0)
    harmless = (F.col("numeric") == 1) | (F.col("at_sign") == 1) | (F.col("in_path") == 1) | (F.col("coverage") >= 0.8)
    certain = told & ~harmless & (F.col("digits") > 0.1) & (F.col("length") >= 8)
    return F.when((F.col("format") == 1) | certain, 1.0).when(plain | (harmless & ~told), 0.0)


def training(rows: DataFrame, masked: bool = True) -> DataFrame:
    """(label, weight, features): the labelled findings among `rows`, each described value once, thinned.

    A class under half of LABELLED_FINDINGS is kept whole; the other gets what is left. Weights
    restore the proportion of the classes. With ``masked`` each finding is given twice, once with
    nothing to see of LABELLED_BY, so that the other inputs are learned too.
    """
    named = stored(rows.filter("label is not null").select("label", "value", *FEATURES).distinct(), "named")
    counts = {r["label"]: r["count"] for r in named.groupBy("label").count().collect()}
    half = LABELLED_FINDINGS // 2
    few = min(counts.values(), default=0)
    share = {label: min(1.0, max(half, LABELLED_FINDINGS - few) / n) if n > few else min(1.0, half / n) for label, n in counts.items()}
    rate = F.when(F.col("label") == 1, share.get(1.0, 1.0)).otherwise(share.get(0.0, 1.0))
    chosen = named.filter(F.pmod(F.xxhash64("value", *FEATURES), F.lit(1_000_000_000)) < rate * 1_000_000_000)
    chosen = chosen.select("label", (1 / rate).alias("weight"), *FEATURES)
    if masked:
        chosen = chosen.unionByName(chosen.withColumns({c: F.lit(0.0) for c in LABELLED_BY}))
    return stored(chosen, "labelled")


def findings(docs: DataFrame, labelled: DataFrame | None = None, trees: int = 20) -> DataFrame:
    """One row per candidate: doc_id, mark, place (word from 0), value, probability, secret.

    labelled: findings (value, label 0/1) from a review; without it beyond_doubt() labels, what it
    labels stays so, and the forest decides about all others. With one class of label only there is
    nothing to learn, and the label rule decides alone (undecided candidates are no secrets). Null and empty texts have no candidates; a null doc_id stays null;
    repeated rows give repeated findings. Columns besides doc_id, text and source are not read.
    """
    rows = stored(candidates(docs), "candidates")
    rows = stored(described(rows, vocabulary(docs)), "described")
    if labelled is None:
        rows = rows.withColumn("label", beyond_doubt())
    else:
        named = labelled.filter("label is not null").groupBy("value").agg(F.max("label").cast("double").alias("label"))
        rows = rows.join(named, "value", "left")
    rows = stored(with_neighbours(rows), "weighed")
    chosen = training(rows, masked=labelled is None)
    out = ["doc_id", "mark", "place", "value", "probability", "secret"]
    if chosen.select("label").distinct().count() < 2:
        certain = F.coalesce("label", F.lit(0.0))
        return rows.select("doc_id", "mark", "place", "value", certain.alias("probability"), (certain == 1).alias("secret"))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=6, seed=7, cacheNodeIds=False)
    model = forest.fit(vectors.transform(chosen))
    judged = model.transform(vectors.transform(rows.withColumnRenamed("label", "known_label")))
    chance = vector_to_array("probability")[1]
    if labelled is None:
        chance = F.coalesce("known_label", chance)
    judged = judged.withColumn("chance", chance).drop("probability")
    return judged.withColumn("probability", F.col("chance")).withColumn("secret", F.col("chance") >= 0.5).select(*out)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """findings() without the values: doc_id, place, n_chars, value_sha256, probability, secret."""
    rows = findings(docs, labelled)
    return rows.select("doc_id", "place", F.length("value").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"), "probability", "secret")


def without_secrets(docs: DataFrame, labelled: DataFrame | None = None, replacement: str = "[SECRET]") -> DataFrame:
    """`docs`, all columns, with every secret in `text` replaced; no row goes.

    Null and empty texts stay as they are; repeated rows are replaced alike, with or without a doc_id;
    an empty table stays empty.
    """
    secret = findings(docs, labelled).filter("secret")
    # One row for each document with a secret, longest values first. Short ones go where something assigns them only.
    values = secret.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set(F.struct((-F.length("value")).alias("size"), "value"))).alias("secrets"))
    values = values.select(F.col("doc_id").alias("secret_id"), F.col("mark").alias("secret_mark"), "secrets")
    held = docs.select(F.struct("*").alias("doc"))
    mark = F.xxhash64(F.coalesce(F.col("doc.text").cast("string"), F.lit("")))
    same = F.col("doc.doc_id").cast("long").eqNullSafe(F.col("secret_id")) & (mark == F.col("secret_mark"))
    joined = held.join(values, same, "left")
    plain = F.lit(replacement.replace("\\", "\\\\").replace("$", "\\$"))

    def replaced(text, s):
        quoted = F.concat(F.lit(r"(?<=(?:[=:>]|(?i:bearer))[\x20\x09-\x0D\"'`(\[{]{0,8})\Q"), s["value"], F.lit(r"\E(?![A-Za-z0-9])"))
        return F.when(F.length(s["value"]) >= 12, F.replace(text, s["value"], F.lit(replacement))).otherwise(F.regexp_replace(text, quoted, plain))

    redacted = F.aggregate("secrets", F.col("doc.text"), replaced)
    changed = F.when(F.col("secrets").isNull(), F.col("doc.text")).otherwise(redacted)
    return joined.select(*[(changed if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
