"""Secret scan in DataFrame operations: candidates by shape, false positives removed by a random forest.

A candidate is a run of at least ``MIN_LENGTH`` key characters; a word has as many as it holds, with or without digits.
Its features are its length, the shares and transitions of character kinds, how much of it common words cover, a
published beginning, what its path says and what the words and the name beside it say. The forest is trained from labelled findings. None come with the tables,
so ``labelled_findings`` makes them by rule and hash: keys of many published forms beside the words that introduce
them, and what scanners mistake for keys (checksums, identifiers, addresses, numbers, versions, placeholders).
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import stored

MIN_LENGTH = 12
#: Findings made for training; half of them secrets.
FINDINGS = 6000
THRESHOLD = 0.5
CORE = r"[A-Za-z0-9_+/=-]{12,}"
#: A run: "=" ends one as padding, or joins parts that are all shorter than a key; those before a key are its name.
_K = "[A-Za-z0-9_+/-]"
RUN = f"{_K}{{12,}}={{0,2}}|{_K}{{11}}={{1,2}}|{_K}{{10}}==|(?={CORE})(?:{_K}{{1,11}}=+)++(?:{_K}{{1,11}}(?!{_K}))?"
#: What parts the fields of a word: JSON, query strings, CSV rows, connection strings.
FIELDS = r",;&?{}()|\[\]"
#: Fixed value: beginnings of published key forms.
PREFIXES = r"^(AKIA|ASIA|sk_live_|ghp_|xox[abp]-|glpat-|npm_|eyJ)"
#: Words that introduce secrets, words that introduce harmless keys, and path parts of samples.
SECRET_WORDS = ["password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "auth", "credential", "private_key", "bearer"]
HARMLESS_WORDS = ["commit", "sha1", "sha256", "md5", "checksum", "digest", "uuid", "guid", "etag", "revision", "isbn", "order", "invoice", "version", "phone", "card"]
SAMPLE_PATHS = ["test", "tests", "example", "examples", "sample", "fixture", "fixtures", "docs", "mock"]
#: Words that fill placeholders and identifiers.
DICTIONARY = [
    "access", "account", "admin", "after", "before", "change", "client", "config", "connection", "count", "data", "default", "demo",
    "dummy", "error", "example", "file", "first", "handler", "here", "index", "insert", "item", "key", "last", "list", "local", "manager",
    "message", "model", "name", "number", "object", "page", "password", "placeholder", "public", "query", "request", "response", "result",
    "sample", "secret", "server", "service", "session", "state", "string", "system", "table", "test", "time", "token", "type", "update",
    "user", "value", "version", "view", "your",
]
FEATURES = ["length", "digits", "uppers", "lowers", "others", "changes", "variety", "hex_only", "covered", "sample_path", "secret_word", "harmless_word", "dotted", "quoted", "prefixed", "assigned", "vowels"]


def _any(words: list[str]) -> str:
    return "(?i)(" + "|".join(words) + ")"


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """id, path, word_at, run_at, candidate, word, before, after: every run of key characters of every word. ``word`` is
    the field of the word in which the run stands. Null and empty texts have none; a text of any length is read whole."""
    words = F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+")
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    split = docs.select(F.col(id_col).alias("id"), path.alias("path"), words.alias("words"))
    shaped = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1), lambda i: (F.length(F.get("words", i)) >= MIN_LENGTH) & F.get("words", i).rlike(CORE)
    )
    placed = split.where(F.size("words") > 0).withColumn("word_at", F.explode(shaped))
    blank = F.lit("")
    found = placed.select(
        "id", "path", "word_at", F.get("words", F.col("word_at")).alias("whole"),
        F.concat_ws(" ", F.coalesce(F.get("words", F.col("word_at") - 2), blank), F.coalesce(F.get("words", F.col("word_at") - 1), blank)).alias("earlier"),
        F.coalesce(F.get("words", F.col("word_at") + 1), blank).alias("next"),
    )
    cut = found.withColumns({"runs": F.regexp_extract_all("whole", F.lit(RUN), F.lit(0)), "gaps": F.split("whole", RUN)})
    run = lambda i: F.coalesce(F.get("runs", i), blank)

    def beside(i: Column) -> Column:
        # only the neighbours of a run are copied, so a word of any length costs its length
        return F.struct(
            run(i).alias("candidate"), i.alias("run_at"), F.concat(run(i - 1), F.get("gaps", i)).alias("lead"),
            F.concat(F.get("gaps", i + 1), run(i + 1)).alias("tail"), F.when(i == F.size("runs") - 1, F.col("next")).otherwise(blank).alias("after"),
        )

    listed = F.filter(F.transform(F.sequence(F.lit(0), F.size("runs") - 1), beside), lambda r: F.length(r["candidate"]) >= MIN_LENGTH)
    each = cut.where(F.size("runs") > 0).select("id", "path", "word_at", "earlier", F.explode(listed).alias("r")).select("id", "path", "word_at", "earlier", "r.*")
    lead, tail = F.regexp_replace("lead", f"(?s)^.*[{FIELDS}]", ""), F.regexp_extract("tail", f"^[^{FIELDS}]*", 0)
    own = each.withColumns({"lead": lead, "word": F.concat(lead, "candidate", tail)})
    # a name in the field says more than the words before a later field
    near = F.when((F.col("run_at") == 0) | ~F.col("lead").rlike("[A-Za-z]"), F.col("earlier"))
    return own.select("id", "path", "word_at", "run_at", "candidate", "word", F.concat_ws(" ", near, "lead").alias("before"), "after")


def features(found: DataFrame) -> DataFrame:
    """Adds the feature columns to rows (candidate, word, before, after, path)."""
    c, n = F.col("candidate"), F.length("candidate").cast("double")

    def share(kind: str) -> Column:
        return F.length(F.regexp_replace(c, f"[^{kind}]", "")) / n

    kinds = F.translate(F.translate(F.translate(c, _LOWER, "a" * 26), _UPPER, "A" * 26), _DIGITS, "0" * 10)
    changes = F.length(F.regexp_replace(kinds, r"(.)\1*", "$1")) - 1
    uncovered = F.length(F.regexp_replace(F.lower(c), "|".join(sorted(DICTIONARY, key=len, reverse=True)), ""))
    return found.withColumns({
        "length": n, "digits": share("0-9"), "uppers": share("A-Z"), "lowers": share("a-z"), "others": share("_+/=-"),
        "changes": changes / n, "variety": F.size(F.array_distinct(F.split(c, ""))) / n,
        "hex_only": c.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"), "covered": 1 - uncovered / n,
        "sample_path": F.col("path").rlike(r"(?i)(^|[/._-])(" + "|".join(SAMPLE_PATHS) + r")([/._-]|$)").cast("double"),
        "secret_word": F.col("before").rlike(_any(SECRET_WORDS)).cast("double"),
        "harmless_word": (F.col("before").rlike(_any(HARMLESS_WORDS)) | F.col("after").rlike(_any(HARMLESS_WORDS))).cast("double"),
        "dotted": F.col("word").rlike(r"[@.][A-Za-z0-9]").cast("double"), "quoted": F.col("word").rlike("[\"']").cast("double"),
        "prefixed": c.rlike(PREFIXES).cast("double"), "assigned": F.col("before").rlike("[=:][\\s\"'({\\[]*$").cast("double"),
        "vowels": share("aeiouyAEIOUY"),
    })


_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def labelled_findings(spark: SparkSession, rows: int = FINDINGS) -> DataFrame:
    """candidate, word, before, after, path, label: made from the row number alone, the same on every run."""
    h = F.sha2(F.col("id").cast("string"), 512)
    draw = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1 << 20)).cast("int")
    size = lambda low, high, k: F.lit(low) + draw(k) % (high - low + 1)
    upper = F.upper(F.translate(F.base64(F.unhex(h)), "+/=", "XYZ"))
    mixed, hexes = F.translate(F.base64(F.unhex(h)), "=", ""), h
    pick = lambda words, k: F.element_at(F.array(*[F.lit(w) for w in words]), draw(k) % len(words) + 1)
    phrase = lambda k: F.concat_ws("_", pick(DICTIONARY, k), pick(DICTIONARY, k + 1), pick(DICTIONARY, k + 2))
    plain, named = F.lit("is the"), F.concat(F.lit("and "), pick(SECRET_WORDS, 1), pick([" =", ":", "=", " is"], 2))
    harmless, digits = pick(HARMLESS_WORDS, 3), F.regexp_replace(F.translate(h, "abcdef", "012345"), "[^0-9]", "")
    letters = F.translate(mixed, "0123456789+/", "QwErTzUiOpXk")
    syllable = lambda k: F.concat(pick(list("bcdfghklmnprstvw"), k), pick(["a", "e", "i", "o", "u", "er", "an", "io", "ent", "al"], k + 1))
    spoken = lambda k: F.concat(*[syllable(k + 2 * j) for j in range(6)], F.when(draw(k + 12) % 2 == 0, syllable(k + 13)).otherwise(""))
    mention = F.concat(F.lit("the "), pick(SECRET_WORDS, 32))
    assigned = F.concat(F.lit("and "), pick(SECRET_WORDS, 33), pick([" =", ":", "="], 34))
    forms = [  # candidate, words before, quoted, dotted word, secret
        (F.concat(F.lit("AKIA"), F.substr(upper, F.lit(1), F.lit(16))), plain, 0, 0, 1),
        (F.concat(F.lit("AKIA"), F.substr(upper, F.lit(9), F.lit(16))), named, 1, 0, 1),
        (F.substr(hexes, F.lit(1), size(16, 64, 4)), named, 0, 0, 1),
        (F.substr(hexes, F.lit(1), size(16, 64, 5)), named, 1, 0, 1),
        (F.upper(F.substr(hexes, F.lit(1), size(16, 64, 6))), named, 1, 0, 1),
        (F.substr(mixed, F.lit(1), size(20, 64, 7)), named, 1, 0, 1),
        (F.concat(pick(["sk_live_", "ghp_", "xoxb-", "glpat-", "npm_"], 8), F.substr(mixed, F.lit(1), size(24, 40, 9))), plain, 0, 0, 1),
        (F.substr(mixed, F.lit(1), size(32, 64, 10)), plain, 1, 0, 1),
        (F.substr(hexes, F.lit(1), pick([32, 40, 64], 11)), harmless, 0, 0, 0),
        (F.substr(hexes, F.lit(1), pick([32, 40, 64], 12)), harmless, 1, 0, 0),
        (F.concat_ws("-", *[F.substr(hexes, F.lit(a), F.lit(b)) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), pick(["id", "uuid"], 13), 0, 0, 0),
        (F.substr(digits, F.lit(1), size(12, 20, 14)), plain, 0, 0, 0),
        (F.concat_ws("-", F.substr(digits, F.lit(1), F.lit(3)), F.substr(digits, F.lit(4), F.lit(3)), F.substr(digits, F.lit(7), F.lit(4))), plain, 0, 0, 0),
        (F.concat(phrase(15), F.lit("_"), draw(16) % 100), plain, 0, 0, 0),
        (F.concat(pick(["your_", "example_", "test-", "dummy-", "my_"], 17), phrase(18), draw(21) % 10), named, 1, 0, 0),
        (F.concat(pick(DICTIONARY, 22), draw(23) % 100, F.lit("-"), phrase(24)), plain, 0, 1, 0),
        # without a digit
        (F.translate(F.concat(F.lit("AKIA"), F.substr(upper, F.lit(1), F.lit(16))), _DIGITS, "BCDFGHJKLM"), plain, 0, 0, 1),
        (F.substr(letters, F.lit(1), size(20, 64, 40)), assigned, 1, 0, 1),
        (F.substr(letters, F.lit(1), size(20, 64, 41)), plain, 1, 0, 1),
        (spoken(50), assigned, 1, 0, 1),
        (spoken(70), plain, 0, 0, 0),
        (F.initcap(spoken(90)), plain, 0, 0, 0),
        (F.upper(spoken(110)), plain, 0, 0, 0),
        (spoken(130), mention, 0, 0, 0),
        (F.concat_ws("-", spoken(150), pick(DICTIONARY, 170)), plain, 0, 0, 0),
        (F.concat(phrase(171), F.lit("_"), pick(DICTIONARY, 174)), plain, 1, 0, 0),
        (F.concat(pick(["your_", "example_", "test-", "dummy-", "my_"], 175), phrase(176)), assigned, 1, 0, 0),
        (F.concat(F.lit("/"), F.translate(phrase(180), "_", "/"), F.lit("/"), pick(DICTIONARY, 184)), plain, 0, 0, 0),
        (F.concat(pick(["-", "_", "/", "+"], 185), F.repeat(pick(["-", "_"], 186), size(12, 60, 187))), plain, 0, 0, 0),
        # in an address
        (F.substr(mixed, F.lit(1), size(20, 40, 188)), F.concat(F.lit("and postgres://"), pick(DICTIONARY, 189), F.lit(":")), 0, 1, 1),
    ]

    def made(k: int, candidate: Column, before: Column, quoted: int, dotted: int, label: int) -> DataFrame:
        c = F.col("candidate")
        word = F.concat(F.lit('"'), c, F.lit('"')) if quoted else F.concat(c, F.lit(".example.com")) if dotted else c
        sampled = F.when(draw(30) % 5 == 0, F.concat(pick(SAMPLE_PATHS, 31), F.lit("/file"))).otherwise("src/file")
        ids = spark.range(k, rows, len(forms), 1)
        out = ids.select(candidate.cast("string").alias("candidate"), before.alias("before"), F.lit("of it").alias("after"), sampled.alias("path"), F.lit(float(label)).alias("label"))
        return out.withColumn("word", word)

    # one small plan per form: a single projection of all of them is too long to be compiled
    return reduce(DataFrame.unionByName, [made(k, *form) for k, form in enumerate(forms)])


def train(findings: DataFrame, trees: int = 40, depth: int = 8, seed: int = 6) -> RandomForestClassificationModel:
    """A forest from labelled rows (candidate, word, before, after, path, label)."""
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features(stored(findings, "findings"))).select("features", "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8).fit(rows)


def scan(
    docs: DataFrame, model: RandomForestClassificationModel, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """id, word_at, run_at (among the runs of its word, from 0), candidate, score, secret: one row per candidate. Repeated rows give repeated findings."""
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features(candidates(docs, id_col, text_col, path_col)))
    scored = model.transform(rows).withColumn("score", F.element_at(vector_to_array("probability"), 2))
    return scored.select(F.col("id").alias(id_col), F.col("word_at").cast("long"), F.col("run_at").cast("long"), "candidate", "score", (F.col("score") >= threshold).alias("secret"))
