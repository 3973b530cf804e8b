"""Secret scans: candidates by pattern, false positives removed by a random forest. Columns and SQL functions only.

A candidate is one of three: what follows an assignment to a name of secrets, at least MIN_NAMED characters, with digits
or without; the password of an address (scheme://user:password@); any other run of at least MIN_LENGTH key characters
with a digit, which ends at = and : and is no name of secrets before an assignment, so that a name is never part of its
value. A run without a digit and without a name is no candidate. Splitting the text at the candidates gives the gaps
between them; `before` is the last 60 characters of the text before a candidate, other candidates included. Texts are
scanned once for candidates, which are saved with their places, numbered from 0 in each text.

A lexicon is counted over all texts: the words of four to twelve letters a to z that make up WORD_SHARE or more of them
(at most 1 / WORD_SHARE, so it may be broadcast), and how likely each letter follows another in them. Features: length,
shares of character classes and changes between them, distinct characters, mean log-likelihood of the letter pairs,
how much of the candidate lexicon words cover, whether the words before it name a secret or something harmless, an
assignment and quotes around it, its shape, whether it has the format of a known key, and whether the path is one of
tests, samples or lock files.

The forest learns from labelled findings (before, value, after, path, label; at most max_rows of them, those with the
smallest hash, half of the bound for each label). Where none are given, it learns from EXAMPLES made ones, whose label
comes from what was made (examples()), not from a feature. The format of a known key is a feature like others. What a
scan saves in plain text on its way goes when it ends. Labelled findings of one label only give that label to all others.

Null and empty texts have no candidates. Rows that share an id keep their findings apart only by place.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.cluster import saved, scratch

MIN_LENGTH, MIN_NAMED, MAX_ROWS, EXAMPLES, THRESHOLD = 12, 4, 20_000, 6_000, 0.5
WORD_SHARE = 1 / 20_000
#: Characters before a candidate that are looked at, and as many candidates as these may hold.
BEFORE, NEAR = 60, 16
MASK = "[SECRET]"
#: Words of names that hold secrets, and of names or text that stand before harmless values.
SECRET_NAMES = (
    "token(?!i[sz])|secret(?!ar)|passw|passphrase|(?<![a-z])pass(?![a-z])|pwd|api.?key|apikey|access.?key|private.?key|auth(?!or(?!i[sz]at))|credential|bearer|(?<![a-z])signing"
)
HARMLESS_NAMES = "author(?!i[sz]at)|user.?name|login|commit|sha1|sha256|md5|checksum|digest|revision|uuid|guid|isbn|issn|version|mail|phone|tel|call|http|href|url|card"
#: Formats of keys that need no name.
FORMATS = (
    r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_\-]{20,}|xox[abeoprs]-[A-Za-z0-9\-]{10,}|sk-[A-Za-z0-9_\-]{20,}|[rs]k_(?:live|test)_[A-Za-z0-9]{16,}|"
    r"AIza[A-Za-z0-9_\-]{35}|eyJ[A-Za-z0-9_\-]{8,}\.eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]+|SG\.[A-Za-z0-9_\-]{16,}\.[A-Za-z0-9_\-]{16,}|npm_[A-Za-z0-9]{36}|hf_[A-Za-z0-9]{30,}"
)
_Q = "[\\\\\"'`]"
_SCHEME = r"(?:(?i:bearer|basic)\s{1,2})"
_ASSIGN = rf"[\\\]\"'`]{{0,3}}\s{{0,3}}(?:=>|:=|==?|:)\s{{0,3}}{_SCHEME}?{_Q}{{0,2}}"
_NAMED = rf"(?i:{SECRET_NAMES})[A-Za-z0-9_.\-]{{0,24}}{_ASSIGN}"
#: Cheap signs come first: few places reach the name.
_NAMED_VALUE = (
    rf"(?<=[\s=:>\"'`])(?<=(?:[=:>]|(?i:bearer|basic)\s)[\s\\\"'`]{{0,5}})(?![\s\\\"'`=:>])(?!{_SCHEME})(?<={_NAMED})"
    rf"(?:(?<=[\"'`])[^\s\"'`\\]{{{MIN_NAMED},}}(?=[\"'`\\])|[^\s\"'`\\<>&,;]{{{MIN_NAMED - 1},}}[^\s\"'`\\<>&,;.:?])"
)
_ADDRESS_VALUE = r"(?<=:)(?<=://[A-Za-z0-9_.\-]{1,32}:)[^\s\"'`@/]+(?=@)"
_RUN = (
    rf"(?<![A-Za-z0-9_+/.@\-])(?=[A-Za-z_+/.@\-]*[0-9])(?![A-Za-z0-9_.\-]*?{_NAMED})[A-Za-z0-9_+/.@\-]{{{MIN_LENGTH},}}(?:={{1,2}}(?![A-Za-z0-9_+/=.@\-$\"'`]))?"
)
_CANDIDATE = f"{_ADDRESS_VALUE}|{_NAMED_VALUE}|{_RUN}"
#: Words that stand for no value or for one that is elsewhere.
NO_VALUES = "none|null|nil|true|false|undefined|required|optional|string|changeme|password|secret|token"
TEST_PATHS = "test|spec|fixture|example|sample|mock|\\.lock$|lock\\.json$|min\\.js$"
FEATURES = [
    "f_length", "f_digits", "f_upper", "f_hex", "f_runs", "f_distinct", "f_transition", "f_words", "f_secret_name", "f_harmless_name", "f_assigned", "f_quoted", "f_shape", "f_format", "f_test_path",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """doc_id, n, start (characters before it), value, before, after, path of every candidate."""
    path = F.col(path_col).cast("string") if path_col and path_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), path.alias("path"))
    rows = rows.withColumn("found", F.regexp_extract_all("text", F.lit(_CANDIDATE), F.lit(0))).where(F.size("found") > 0)
    rows = rows.withColumn("gaps", F.split("text", _CANDIDATE, -1)).drop("text").withColumn("row", F.monotonically_increasing_id())
    end = lambda x: F.substring(x, -BEFORE, BEFORE)

    def piece(i: Column) -> Column:
        k = F.least(i, F.lit(NEAR))
        earlier = F.zip_with(F.slice("gaps", i - k + 1, k), F.slice("found", i - k + 1, k), lambda gap, value: F.concat(end(gap), end(value)))
        after = F.concat(F.substring(F.get("gaps", i + 1), 1, 20), F.coalesce(F.substring(F.get("found", i + 1), 1, 20), F.lit("")))
        return F.struct(
            i.alias("n"), F.get("found", i).alias("value"), F.length(F.get("gaps", i)).alias("gap"),
            end(F.concat(F.array_join(earlier, ""), end(F.get("gaps", i)))).alias("before"), F.substring(after, 1, 20).alias("after"),
        )

    rows = rows.select("doc_id", "path", "row", F.explode(F.transform(F.sequence(F.lit(0), F.size("found") - 1), piece)).alias("c")).select("doc_id", "path", "row", "c.*")
    w = Window.partitionBy("row").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum((F.col("gap") + F.length("value")).cast("long")).over(w) - F.length("value")
    return rows.select("doc_id", "n", start.alias("start"), "value", "before", "after", "path")


def lexicon(docs: DataFrame, text_col: str = "text", *, save=saved) -> DataFrame:
    """token and weight: 1 of the common words of all texts, and of every pair of letters in them the log-likelihood of
    the second after the first."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text_col), F.lit("[a-z]{4,}"), F.lit(0))).alias("token")).where(F.length("token") <= 12)
    counts = save(words.groupBy("token").agg(F.count("*").alias("n")), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    words = counts.where(F.col("n") >= max(1, WORD_SHARE * total))
    pairs = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring("token", i, F.lit(2)))).alias("token"), "n")
    pairs = pairs.groupBy("token").agg(F.sum("n").alias("n"))
    first = pairs.groupBy(F.substring("token", 1, 1).alias("a")).agg(F.sum("n").alias("all"))
    pairs = pairs.join(first, F.substring("token", 1, 1) == F.col("a")).select("token", F.log((F.col("n") + 1) / (F.col("all") + 26)).alias("weight"))
    return save(words.select("token", F.lit(1.0).alias("weight")).union(pairs), "lexicon")


def _read(found: DataFrame, words: DataFrame, save) -> DataFrame:
    """found with f_transition and f_words."""
    keyed = save(found.withColumn("__key", F.monotonically_increasing_id()), "findings")
    pairs = F.regexp_extract_all(F.lower("value"), F.lit("(?=([a-z]{2}))"), F.lit(1))  # each letter starts one
    parts = F.split(F.lower(F.regexp_replace("value", "([a-z])([A-Z])", "$1 $2")), "[^a-z]+")
    tokens = keyed.select("__key", F.explode(F.concat(pairs, F.filter(parts, lambda x: F.length(x) >= 4))).alias("token"))
    is_pair = F.length("token") == 2
    rare = -F.log(F.lit(26.0))  # of pairs that no word has
    read = tokens.join(F.broadcast(words), "token", "left").groupBy("__key").agg(  # at most 1 / WORD_SHARE words and all pairs
        F.avg(F.when(is_pair, F.coalesce("weight", 2 * rare))).alias("f_transition"), F.sum(F.when(~is_pair & F.col("weight").isNotNull(), F.length("token"))).alias("covered")
    )
    return keyed.join(read, "__key", "left").withColumns({"f_transition": F.coalesce("f_transition", rare), "f_words": F.coalesce("covered", F.lit(0)) / F.length("value")}).drop("covered", "__key")


def features(found: DataFrame, words: DataFrame, *, save=saved) -> DataFrame:
    """found with FEATURES; words: a lexicon. save gets the findings, in plain text."""
    v, n = F.col("value"), F.length("value")
    without = lambda pattern: (n - F.length(F.regexp_replace(v, pattern, ""))) / n
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    name = F.regexp_extract("before", r"([\p{L}\p{N}_.\- ]{0,40})[\s\"'`]*[:=]?[\s\"'`(]*$", 1)
    near = F.substring(name, -24, 24)
    shape = (
        F.when(v.rlike(r"^[0-9.:+\-]+$"), 1.0).when(v.rlike(r"^[^@]+@[^@]+\.[A-Za-z]{2,}\.?$"), 2.0).when(v.rlike(r"\.[a-z]{2,4}$"), 3.0)
        .when(v.rlike("^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}"), 4.0).when(v.rlike(r"[${}<>()%]|^(.)\1*$"), 5.0).when(v.rlike(f"(?i)^(?:{NO_VALUES})$"), 6.0).otherwise(0.0)
    )
    in_address = F.col("before").rlike(r"://[A-Za-z0-9_.\-]{1,32}:$") & F.col("after").startswith("@")
    return _read(found, words, save).select(
        "*",
        n.cast("double").alias("f_length"),
        without("[0-9]").alias("f_digits"),
        without("[A-Z]").alias("f_upper"),
        without("[0-9a-fA-F]").alias("f_hex"),
        (F.size(F.regexp_extract_all(v, F.lit("[0-9]+|[A-Z]+|[a-z]+|[^0-9A-Za-z]+"), F.lit(0))) / n).alias("f_runs"),
        (F.size(F.array_distinct(F.split(v, ""))) / n).alias("f_distinct"),
        yes(near.rlike(f"(?i)({SECRET_NAMES})") | F.col("before").rlike(f"{_NAMED}$") | in_address).alias("f_secret_name"),
        yes(near.rlike(f"(?i)\\b({HARMLESS_NAMES})")).alias("f_harmless_name"),
        yes(F.col("before").rlike(rf"(?:[:=]|=>)\s*{_SCHEME}?{_Q}*$|{_SCHEME}$")).alias("f_assigned"),
        yes(F.col("before").rlike(r"[\"'`]$") & F.col("after").rlike(f"^{_Q}")).alias("f_quoted"),
        shape.alias("f_shape"),
        yes(v.rlike(f"^(?:{FORMATS})$")).alias("f_format"),
        yes(F.col("path").rlike(f"(?i)({TEST_PATHS})")).alias("f_test_path"),
    )


def examples(spark: SparkSession, n: int = EXAMPLES) -> DataFrame:
    """n made findings (before, value, after, path, label), the odd ones secrets. Each is drawn by hash from its number:
    generated keys, passwords of words and digits, and passwords in addresses under names of secrets; digests,
    identifiers, addresses, numbers, file names, versions, placeholders and user names as they stand in code and prose,
    some of them under names that hold a name of secrets or in files of tests."""
    r = lambda salt, m: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(m)).cast("int")
    pick = lambda salt, options: F.element_at(F.array(*[F.lit(x) for x in options]), r(salt, len(options)) + 1)
    raw = lambda salt: F.sha2(F.concat_ws(",", F.lit(salt), F.col("id").cast("string")), 256)
    hexes = lambda salt, *sizes: F.substring(raw(salt), F.lit(1), pick(f"{salt}n", sizes))
    mixed = lambda salt, low, high: F.substring(F.regexp_replace(F.base64(F.unhex(raw(salt))), "[+/=]", "k"), F.lit(1), r(f"{salt}n", high - low) + low)
    number = lambda salt, m: r(salt, m).cast("string")
    nouns = "tiger lily horse battery staple correct summer winter dragon monkey orange river mountain silver hunter shadow coffee garden planet rocket".split()
    word = lambda salt: pick(salt, nouns)
    password = F.element_at(F.array(F.concat(word("w1"), number("d1", 10_000)), F.concat(word("w1"), word("w2"), word("w3")), F.concat(F.initcap(word("w1")), pick("sign", "!@#$-_."), number("d1", 1000), word("w2")), F.concat(word("w1"), word("w2")), mixed("p", 8, 16)), r("pk", 5) + 1)
    key = F.element_at(F.array(mixed("k", 16, 41), hexes("h", 32, 40, 64), mixed("k2", 20, 33), F.upper(hexes("h2", 20, 32))), r("kk", 4) + 1)
    names = ["token", "api_key", "apiKey", "API_KEY", "secret", "client_secret", "access_key", "AWS_SECRET_ACCESS_KEY", "auth_token", "private_key", "credential", "signing_key", "bearer_token", "secret_id"]
    passes = ["password", "passwd", "db_pass", "PASSWORD", "pwd", "mail_password", "passphrase"]
    quoted = r("q", 3) > 0
    sign = F.when(quoted, pick("sq", [' = "', '="', ": \"", '": "', '":"', " => '", "='"])).otherwise(pick("su", ["=", ":", ": ", " = ", "?", "="]))
    sign = F.when(sign == "?", F.lit("=")).otherwise(sign)
    close = F.when(quoted, pick("cq", ['"', '",', '"}'])).otherwise(pick("cu", ["", " ", "\n", "&page=2"]))
    close = F.when(sign.endswith("'"), F.lit("'")).otherwise(close)
    lead = pick("lead", ["", "then ", "the setting ", "{\"", "export ", "https://www.example.com/x?", "config: "])
    case = lambda before, value, after="": F.struct(F.coalesce(before, F.lit("")).alias("before"), value.alias("value"), (F.lit(after) if isinstance(after, str) else after).alias("after"))
    prose = pick("prose", ["we saw ", "see the page ", "written by ", "call ", "on ", "at ", "and then ", "of the year ", "mail ", "(", "\n"])
    known = F.element_at(F.array(F.concat(pick("kf", ["AKIA", "ASIA"]), F.upper(F.substring(raw("kr"), 1, 16))), F.concat(pick("kf", ["ghp_", "npm_", "hf_", "AIza"]), mixed("k4", 36, 37)), F.concat(pick("kf", ["sk-", "glpat-", "xoxb-", "sk_live_", "rk_test_"]), mixed("k5", 20, 41)), F.concat(F.lit("eyJ"), mixed("k6", 10, 30), F.lit(".eyJ"), mixed("k7", 10, 30), F.lit("."), mixed("k8", 20, 40))), r("kk2", 4) + 1)
    secret = [
        case(F.concat(lead, pick("name", names), sign), key, close), case(F.concat(lead, pick("name", names), sign), key, close),
        case(F.concat(lead, pick("pass", passes), sign), password, close), case(F.concat(pick("lead2", ["", "", "\n"]), pick("pass", passes), sign), password, close),
        case(F.concat(pick("scheme", ["postgres", "mysql", "https", "redis"]), F.lit("://"), pick("user", ["admin", "root", "app"]), F.lit(":")), password, "@db.example.com/x"),
        case(pick("kp", ["we saw ", "and then ", "(", "key ", "\n", "token = ", 'api_key="']), known, " "),
        case(pick("bearer", ["Authorization: Bearer ", "authorization: Basic ", "-H 'Authorization: Bearer "]), mixed("k3", 16, 43), ""),
    ]
    uuid = F.concat_ws("-", *[F.substring(raw("u"), a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    plain = [
        case(F.concat(pick("hn", ["commit", "sha256", "md5", "checksum", "revision", "digest", "sha1"]), pick("hs", [" ", ": ", "=", ' "', "-"])), hexes("g", 12, 32, 40, 64), " "),
        case(F.concat(pick("un", ["uuid", "id", "guid", "request", "session of user", "version"]), pick("us", [" ", ": ", "=", '="'])), uuid, " "),
        case(prose, F.concat(word("w1"), pick("m1", [".", "_", "-", ""]), word("w2"), number("d", 1000), F.lit("@mail"), number("d2", 50), F.lit(".example.com")), " or"),
        case(prose, F.element_at(F.array(F.concat(F.lit("+4930"), number("d", 100_000_000)), F.concat(F.lit("2024-0"), number("d3", 9), F.lit("-1"), number("d4", 9), F.lit("T10:2"), number("d5", 9)), F.concat(F.lit("555123456"), number("d", 10_000_000)), F.concat_ws(".", F.lit("192.168"), number("d3", 255), number("d4", 255))), r("nk", 4) + 1), " "),
        case(prose, F.concat(pick("site", ["www.example.com/2024/", "https://shop.example.org/", "static/img/", "/usr/share/"]), word("w1"), number("d", 1000), pick("ext", [".html", ".png", ".txt", "/index", ".min.js"])), " "),
        case(prose, F.concat(word("w1"), F.lit("_"), word("w2"), pick("m2", ["_", "-", ""]), number("d", 2100)), " "),
        case(F.concat(pick("an", ["Author: ", "author=", "user_name: ", "login ", "secretary: ", "by "])), F.concat(word("w1"), F.lit("_"), word("w2"), number("d", 2100)), " wrote it"),
        case(F.concat(lead, pick("pn", [*names, *passes]), sign), pick("pv", ["${DB_PASSWORD1}", "{{ vault_token }}", "<your-token-here>", "********", "xxxxxxxxxxxx", "os.environ['KEY_1']", "process.env.API_KEY_2", "%(password)s", "$SECRET_KEY", "None", "null", "required", "undefined", "string", "changeme"]), close),
        case(F.concat(pick("tn", ["tokenizer=", "max_tokens=", "tokenizer: ", "author_token_count: ", "tokenization = ", "secretary="])), F.concat(word("w1"), F.lit("_"), word("w2"), F.lit("_"), number("d", 500), pick("ext2", ["", ".json", "k.json"])), "\n"),
        case(prose, hexes("g2", 12, 16, 20), " "),
        case(F.concat(pick("name", ["the password ", "a secret of ", "the token is "])), F.concat(word("w1"), F.lit(" ")), " of"),
    ]
    rows = spark.range(n).withColumn("label", F.col("id") % 2)
    made = F.when(F.col("label") == 1, F.element_at(F.array(*secret), r("sk", len(secret)) + 1)).otherwise(F.element_at(F.array(*plain), r("hk", len(plain)) + 1))
    path = F.when(F.col("label") == 1, pick("path", ["src/app.py", "config/settings.yml", "web", None])).otherwise(pick("path", ["src/app.py", "docs/index.html", "tests/fixtures/data.json", "package-lock.json", "web", None]))
    return rows.withColumn("c", made).select("c.before", F.trim("c.value").alias("value"), "c.after", path.alias("path"), "label")


def _saved_examples(spark: SparkSession, save) -> DataFrame:
    """examples(), written once: their columns are a large plan that the driver would plan again for each use. As one stage's
    code they take it more memory to compile than other steps of a scan, so this one job goes without."""
    key = "spark.sql.codegen.wholeStage"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return save(examples(spark), "examples")
    finally:
        spark.conf.set(key, before)


def fit(labelled: DataFrame, words: DataFrame, max_rows: int = MAX_ROWS, trees: int = 30, depth: int = 8, seed: int = 11, *, save=saved):
    """(assembler, forest) learned from labelled findings; the one label, or null, where there are not two."""
    rows = labelled.where(F.col("label").isin(0, 1)).select("before", "value", "after", "path", F.col("label").cast("double").alias("label"))
    order = ["order", "value", "before", "after", "path"]
    # half of the bound for each label, so that rare secrets are learned
    half = [rows.where(F.col("label") == x).withColumn("order", F.xxhash64("value", "before")).orderBy(*order).limit(max_rows // 2) for x in (0.0, 1.0)]
    sample = save(features(half[0].union(half[1]), words, save=save).select(*FEATURES, "label").repartition(4, "label", *FEATURES), "sample")
    kinds = [r.label for r in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        return kinds[0] if kinds else None
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed)
    return assembler, forest.fit(assembler.transform(sample))


def findings(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", *, save=saved) -> DataFrame:
    """doc_id, n, start, value, score and is_secret of every candidate of every text. save: as cluster.saved, or of a
    scratch folder; what it saves holds the values."""
    words = lexicon(docs, text_col, save=save)
    fitted = fit(_saved_examples(docs.sparkSession, save) if labelled is None else labelled, words, save=save)
    found = features(candidates(docs, id_col, text_col, path_col), words, save=save)
    if isinstance(fitted, tuple):
        assembler, model = fitted
        score = vector_to_array("probability")[1]
        scored = model.transform(assembler.transform(found)).withColumn("score", score)
    else:
        scored = found.withColumn("score", F.lit(fitted or 0.0))
    return scored.select("doc_id", "n", "start", "value", F.round("score", 6).alias("score"), (F.col("score") >= threshold).alias("is_secret"))


def report(docs: DataFrame, **kw) -> DataFrame:
    """doc_id, n, start, n_chars, value_sha256, score and is_secret of every candidate: no secret leaves the scan."""
    with scratch(docs.sparkSession) as save:  # goes with the plain values
        rows = findings(docs, save=save, **kw)
        return saved(rows.select("doc_id", "n", "start", F.length("value").cast("long").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"), "score", "is_secret"), "secrets")


def without_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = MASK, **kw) -> DataFrame:
    """The rows of docs with every secret in their text replaced by mask; n_chars, if there, follows the text. Rows are
    known by a digest of id and text, so that those with a null id are masked too; rows that share both share their
    secrets."""
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit("\n"), F.col(text_col)))
    docs_ = docs.withColumn("__key", key)
    with scratch(docs.sparkSession) as save:  # goes with the plain values
        bad = findings(docs_, id_col="__key", text_col=text_col, save=save, **kw).where("is_secret")
        bad = saved(bad.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set(F.sha2("value", 256)).alias("__bad")), "secrets")
    parts = F.transform(F.split(F.col(text_col), _CANDIDATE, -1), lambda x, i: F.concat(x, F.coalesce(F.when(F.array_contains("__bad", F.sha2(F.get("__found", i), 256)), F.lit(mask)).otherwise(F.get("__found", i)), F.lit(""))))
    rows = docs_.join(bad, F.col("__key") == F.col("__id"), "left").withColumn("__found", F.when(F.col("__bad").isNotNull(), F.regexp_extract_all(text_col, F.lit(_CANDIDATE), F.lit(0))))
    rows = rows.withColumn(text_col, F.when(F.col("__bad").isNull(), F.col(text_col)).otherwise(F.array_join(parts, "")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("__bad").isNull(), F.col("n_chars")).otherwise(F.length(text_col).cast(docs.schema["n_chars"].dataType)))
    return rows.select(*docs.columns)
