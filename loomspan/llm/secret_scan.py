"""Secrets in texts: proposed by patterns, confirmed by a random forest, in built-in expressions only.

One regular expression proposes candidates: the value assigned to a name that
speaks of a secret, the password of a URL, a whole private key, or a long run
of token characters with a digit.  Each
candidate becomes a row of numbers (`FEATURES`): its length, its character
transitions and their likeness to prose, how much of it a dictionary covers,
path-like parts, the words next to it and the path it was found under.  A random
forest over them removes false positives.  Trees are grown on the driver from
labelled findings (at most `sample` rows, a bound on training only) and applied
as nested CASE expressions, so that scanning runs no Python.

Labelled findings have left, value, right, path (strings) and secret (boolean).
`made_findings` makes a set of them from rules; a table of reviewed findings can
take its place.

Positions are code points.  Neighbouring words reach back to the candidate
before at most.  Defined results: a null or empty text has no candidates; a null
path is unknown; candidates are leftmost and do not overlap, so there are no
ties; repeated rows each get their own result; an empty table gives an empty
result; without labelled findings of both kinds every candidate is confirmed;
other columns are kept and may have any name.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carried, running_sums, table

SAMPLE = 8_000
TREES, DEPTH, LEAF = 15, 7, 4
CUT = 0.5
_NAMES = r"(?:[Kk][Ee][Yy]|[Tt][Oo][Kk][Ee][Nn]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Pp][Aa][Ss][Ss](?:[Ww][Oo][Rr][Dd]|[Ww][Dd]|[Dd]|[Pp][Hh][Rr][Aa][Ss][Ee])?|[Pp][Ww][Dd]|[Cc]redentials?|[Aa]uthorization)"
_ASSIGN = _NAMES + r"[\"']?[ \t]{0,3}[:=]{1,2}[ \t]{0,3}(?:Bearer |Basic )?[\"']?"
_RUN = r"[A-Za-z0-9+/_-]"
#: The login of a URL up to its password.
_LOGIN = r"://[^\s\"'<>/:@]{0,64}:"
_PEM = r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----|(?:\s*+[A-Za-z0-9+/=]{16,}+)*+)"
CANDIDATE = rf"{_PEM}|{_LOGIN}[^\s\"'<>/@]{{3,}}+(?=@)|{_ASSIGN}[^\s\"'`,;<>()\[\]{{}}]{{8,}}+|(?<!{_RUN})(?=[A-Za-z+/_-]*+[0-9]){_RUN}{{20,}}+={{0,2}}+"
#: What a text must hold to be searched at all, the cheaper tests first.
HOLDS = (("[:=]", _ASSIGN + r"[^\s]"), (rf"{_RUN}{{20}}",), ("://", _LOGIN + "[^\\s]"), ("-----BEGIN ",))
#: kind: prefix format, in order; the first that fits names the candidate.
KINDS = {
    "private_key": r"^-----BEGIN [A-Z ]*PRIVATE KEY",
    "aws_key": r"^(?:AKIA|ASIA)[0-9A-Z]{16}$",
    "github_token": r"^gh[pousr]_[A-Za-z0-9]{30,}$",
    "model_key": r"^sk-[A-Za-z0-9_-]{20,}$",
    "google_key": r"^AIza[0-9A-Za-z_-]{35}$",
    "chat_token": r"^xox[abprs]-[0-9A-Za-z-]{10,}$",
    "jwt": r"^eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*$",
    "hub_token": r"^hf_[A-Za-z0-9]{30,}$",
}
BIGRAMS = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur".split()
WORDS = (
    "access account address admin alpha api app array assets async attribute auth base batch beta block branch bucket buffer build cache call change class client code commit common config "
    "content context control core count create data database debug default delete demo description dev docs document domain dummy element email enable encode error event example export "
    "field file filter format function global group handler hash header hello help here home host http https image import index info input insert instance int internal item java json key "
    "label lang length level lib library limit line link list load local lock log login main manager map max memory message meta method min mode model module name native network node null "
    "number object option order output package page param parse password path pattern per plugin point pool port prefix primary private process production project property public python query queue "
    "read record redis ref region remote replace report request resource response result role root route row sample schema scope script search secret select server service session set settings "
    "size source spark sql src start state static status store stream string struct style super system table tag target task temp template test text thread time title token tokens type unit "
    "update upload url user util utils value version view web window with word work world write www yaml your zone"
).split()
_SAYS_SECRET = r"(?i)(?:secret|token|key|passw|pwd|credential|auth|bearer|private)[^\n]{0,14}$"
_SAYS_OTHER = r"(?i)(?:commit|sha-?[0-9]|digest|checksum|hash|uuid|guid|version|build|revision|etag|md5|blob|https?:|order|invoice|path|file|isbn)[^\n]{0,14}$"
_DUMMY = r"(?i)(.)\1{4,}|1234|abcd|xxxx|example|change|your|dummy|sample|placeholder|redacted|test"


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def _entropy(v: Column) -> Column:
    share = lambda c: (F.length(v) - F.length(F.replace(v, c, F.lit("")))) / F.length(v)
    return F.aggregate(F.array_distinct(F.split(v, "")), F.lit(0.0), lambda a, c: F.when(c == "", a).otherwise(a - share(c) * F.log2(share(c))))


def features(left: Column, value: Column, right: Column, path: Column) -> dict[str, Column]:
    n, low = F.length(value), F.lower(value)
    return {
        "length": n.cast("double"),
        "entropy": _entropy(value),
        "digits": _share(_count(value, "[0-9]"), n),
        "capitals": _share(_count(value, "[A-Z]"), n),
        "transitions": _share(_count(value, "[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+") - 1, n),
        "prose": _share(_count(low, f"(?=(?:{'|'.join(BIGRAMS)}))."), n),
        "dictionary": 1 - _share(F.length(F.regexp_replace(low, "|".join(sorted((w for w in WORDS if len(w) > 2), key=lambda w: (-len(w), w))), "")), n),
        "hex": value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "digest_size": n.isin(32, 40, 56, 64, 96, 128).cast("double"),
        "uuid": value.rlike("^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$").cast("double"),
        "parts": _share(_count(value, "[/._-]"), n),
        "dummy": value.rlike(_DUMMY).cast("double"),
        "says_secret": left.rlike(_SAYS_SECRET).cast("double"),
        "says_other": left.rlike(_SAYS_OTHER).cast("double"),
        "url_login": left.rlike(_LOGIN + "$").cast("double"),
        "quoted": (left.rlike("[\"']$") & right.rlike("^[\"']")).cast("double"),
        "prefix": F.greatest(*[value.rlike(p).cast("double") for p in KINDS.values()]),
        "test_path": F.coalesce(path.rlike(r"(?i)test|example|sample|fixture|/docs?/"), F.lit(False)).cast("double"),
    }


FEATURES = ("length", "entropy", "digits", "capitals", "transitions", "prose", "dictionary", "hex", "digest_size", "uuid", "parts", "dummy", "says_secret", "says_other", "url_login", "quoted", "prefix", "test_path")


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int = DEPTH):
    """A tree: the share of secrets in a leaf, or (feature, threshold, tree at or below it, tree above it)."""
    if depth == 0 or len(y) < 2 * LEAF or y.min() == y.max():
        return round(float((y.sum() + 0.5) / (len(y) + 1)), 6)
    best = None
    for f in rng.choice(x.shape[1], max(1, int(np.sqrt(x.shape[1])) + 1), replace=False):
        values = np.unique(x[:, f])
        for cut in np.unique(np.quantile((values[1:] + values[:-1]) / 2, np.linspace(0, 1, 13))) if len(values) > 1 else ():
            low = x[:, f] <= cut
            n, pos = np.array([low.sum(), (~low).sum()]), np.array([y[low].sum(), y[~low].sum()])
            if n.min() >= LEAF:
                gini = float((pos * (n - pos) / n).sum())
                if best is None or gini < best[0] - 1e-12:
                    best = (gini, int(f), round(float(cut), 6), low)
    if best is None:
        return round(float((y.sum() + 0.5) / (len(y) + 1)), 6)
    _, f, cut, low = best
    return f, cut, grow(x[low], y[low], rng, depth - 1), grow(x[~low], y[~low], rng, depth - 1)


class Forest:
    def __init__(self, trees: list):
        self.trees = trees

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = TREES, seed: int = 1) -> Forest:
        rng = np.random.default_rng(seed)
        draws = [rng.integers(0, len(y), len(y)) for _ in range(trees)]
        return cls([grow(x[d], y[d], rng) for d in draws])

    def score(self, row) -> float:
        """As column() computes it, for one row of numbers."""

        def walk(t):
            return t if isinstance(t, float) else walk(t[2] if row[t[0]] <= t[1] else t[3])

        return sum(map(walk, self.trees)) / len(self.trees)

    def column(self, numbers: Column) -> Column:
        """The score of a struct of features."""

        def walk(t):
            return F.lit(t) if isinstance(t, float) else F.when(numbers[FEATURES[t[0]]] <= t[1], walk(t[2])).otherwise(walk(t[3]))

        return sum((walk(t) for t in self.trees), F.lit(0.0)) / len(self.trees)


def train(findings: DataFrame, sample: int = SAMPLE, trees: int = TREES, seed: int = 1) -> Forest:
    """A forest from labelled findings; of more than `sample`, those of the smallest hashes."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = findings.where("value is not null and secret is not null").orderBy(F.xxhash64("left", "value", "right"), "left", "value", "right", "path", "secret").limit(sample)
    got = features(text("left"), F.col("value"), text("right"), F.col("path"))
    rows = rows.select(F.col("secret").cast("double").alias("y"), *[got[f].alias(f) for f in FEATURES]).collect()
    y = np.array([r["y"] for r in rows])
    if not len(y) or y.min() == y.max():
        return Forest([1.0])
    return Forest.fit(np.array([[r[f] for f in FEATURES] for r in rows]), y, trees, seed)


def made_findings(spark: SparkSession, n: int = 7_500) -> DataFrame:
    """Labelled findings by rule: secrets of common formats and what is often taken for one."""
    h = lambda s: f"sha2(concat(id, '{s}'), 256)"
    b62 = lambda s, k: f"substr(translate(concat(base64(unhex({h(s)})), base64(unhex({h(s + 'x')}))), '+/=', 'aZ7'), 1, {k})"
    size = "(20 + pmod(xxhash64(id, 'n'), 21))"
    words = ", ".join(f"'{w}'" for w in WORDS if len(w) > 2)
    word = lambda s: f"element_at(array({words}), cast(1 + pmod(xxhash64(id, '{s}'), {sum(len(w) > 2 for w in WORDS)}) as int))"
    soft = "element_at(array('the ', 'of the ', 'in ', 'value ', 'and then ', 'see ', 'une ', 'der '), cast(1 + pmod(xxhash64(id, 's'), 8) as int))"
    prose = "translate(" + h("p") + ", '0123456789abcdef', 'etaoinshrdlucmfw')"
    name = "element_at(array('token', 'TOKEN', 'api_key', 'secret_key', 'client_secret', 'access_token', 'password', 'auth_key'), cast(1 + pmod(xxhash64(id, 'k'), 8) as int))"
    tie = "element_at(array(' = \"', ': \"', '=\"', ' = ', '=', \": '\"), cast(1 + pmod(xxhash64(id, 't'), 6) as int))"
    said = f"concat({soft}, {name}, {tie})"
    cases = [  # left, value, secret
        (said, f"substr({h('a')}, 1, 40)", 1), (said, f"upper(substr({h('b')}, 1, 40))", 1), (said, f"substr({h('c')}, 1, 32)", 1), (said, h("d"), 1),
        (said, b62("e", size), 1), (said, b62("f", "32"), 1), (said, f"concat({b62('g', '10')}, '!', {b62('h', '4')}, '#9')", 1),
        (f"concat({soft}, 'key ')", f"concat('AKIA', substr(upper({h('i')}), 1, 16))", 1), (soft, f"concat('ghp_', {b62('j', '36')})", 1), (said, f"concat('sk-', {b62('k', '48')})", 1),
        ("'Authorization: Bearer '", b62("l", "40"), 1), (soft, f"concat('AIza', {b62('m', '35')})", 1), (soft, f"concat('hf_', {b62('n', '34')})", 1),
        ("concat('commit ')", f"substr({h('o')}, 1, 40)", 0), ("'sha256:'", h("q"), 0), ("'md5 = '", f"substr({h('r')}, 1, 32)", 0), ("'etag: \"'", f"substr({h('s')}, 1, 32)", 0),
        (soft, f"regexp_replace(substr({h('u')}, 1, 32), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})', '$1-$2-$3-$4-')", 0), (soft, f"substr({h('v')}, 1, 40)", 0),
        (soft, f"concat('src/', {word('a')}, '/', {word('b')}, '_', {word('c')}, '/', {word('d')}, pmod(id, 90))", 0), (soft, f"concat({word('a')}, '_', {word('b')}, '_', {word('c')}, '_v', pmod(id, 9))", 0),
        (said, f"concat('your_', {word('a')}, '_here', pmod(id, 99))", 0), (said, f"concat('changeme', pmod(id, 999), {word('a')})", 0), (said, f"concat({word('a')}, '_', {word('b')}, '_', {word('c')})", 0),
        (said, f"concat('xxxxxxxxxxxx', pmod(id, 9999))", 0), (said, f"concat({word('a')}, '.', {word('b')}, '.', {word('c')})", 0), (soft, f"concat('26', substr(translate({h('w')}, 'abcdef', '012345'), 1, 20))", 0),
        (soft, f"concat(substr({prose}, 1, {size}), pmod(id, 99))", 0), (said, f"substr({prose}, 1, 12)", 0), ("'https://'", f"concat({word('a')}, '/', {word('b')}, '/', {word('c')}, '/', pmod(id, 9999))", 0),
        (f"concat({soft}, 'postgres://', {word('u')}, ':')", b62("y", "12"), 1), (f"concat('mysql://', {word('u')}, ':')", f"concat({word('a')}, pmod(id, 997), '!', {b62('z', '4')})", 1), (f"concat({soft}, 'redis://:')", b62("A", size), 1),
        ("concat('DB_PASS=')", f"concat({b62('B', '5')}, pmod(id, 97), {b62('C', '3')})", 1), (f"concat({soft}, 'passphrase: ')", f"concat({word('a')}, '-', {b62('D', '6')}, '-', pmod(id, 999))", 1), ("concat('MYSQL_PWD=\"')", b62("E", "14"), 1),
        (f"concat({soft}, 'http://', {word('u')}, ':')", f"concat('80', pmod(id, 90))", 0), (f"concat('amqp://', {word('u')}, ':')", "'password'", 0), (f"concat({soft}, 'bypass: ')", f"concat({word('a')}, {word('b')})", 0), ("concat('compass = ')", f"concat({word('a')}, '_', {word('b')})", 0),
        (soft, f"concat('-----BEGIN RSA PRIVATE KEY-----\n', {b62('F', '64')}, '\n', {b62('G', '64')}, '\n', {b62('H', '30')}, '==\n-----END RSA PRIVATE KEY-----')", 1), (soft, f"concat('-----BEGIN PRIVATE KEY-----\n', {b62('I', '64')})", 1),
        (soft, "'-----BEGIN PRIVATE KEY-----'", 0), (soft, "concat(repeat('-', 24), pmod(id, 9))", 0), (soft, f"concat('a', repeat('b', 24), pmod(id, 9))", 0),
    ]
    pick = lambda k: F.expr("CASE cast(pmod(id, {}) as int) {} END".format(len(cases), " ".join(f"WHEN {i} THEN {c[k]}" for i, c in enumerate(cases))))
    quote = F.when(F.expr(f"{pick_left(cases)}").rlike("[\"']$"), F.regexp_extract(F.expr(pick_left(cases)), "([\"'])$", 1)).otherwise(" ")
    path = F.expr("element_at(array('src/main.py', 'tests/fixture.py', 'src9', 'docs/example.md', 'conf/app.env', 'web'), cast(1 + pmod(xxhash64(id, 'w'), 6) as int))")
    return spark.range(n).select(pick(0).alias("left"), pick(1).alias("value"), quote.alias("right"), path.alias("path"), (pick(2) == 1).alias("secret"))


def pick_left(cases: list) -> str:
    return "CASE cast(pmod(id, {}) as int) {} END".format(len(cases), " ".join(f"WHEN {i} THEN {c[0]}" for i, c in enumerate(cases)))


def candidates(text: Column, path: Column) -> Column:
    """array of struct(gap, head, value, numbers): the text before, what of the match is not value, the value, its features."""
    gaps, found = F.split(text, CANDIDATE, -1), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    gaps_next = F.slice(gaps, F.lit(2), F.greatest(F.size(gaps) - 1, F.lit(0)))
    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("m"), gaps_next.alias("after"))

    def one(x: Column) -> Column:
        head = F.regexp_extract(x["m"], f"^(?:{_LOGIN}|{_ASSIGN})", 0)
        value = F.substr(x["m"], F.length(head) + 1)
        return F.struct(x["gap"].alias("gap"), head.alias("head"), value.alias("value"), F.concat(F.right(x["gap"], F.lit(40)), head).alias("left"), F.left(x["after"], F.lit(24)).alias("right"))

    def known(x: Column) -> Column:
        got = features(x["left"], x["value"], x["right"], path)
        return F.struct(x["gap"], x["head"], x["value"], F.struct(*[got[f].alias(f) for f in FEATURES]).alias("numbers"))

    none = F.filter(F.transform(F.array(F.lit("")), lambda s: known(F.struct(s.alias("gap"), s.alias("head"), s.alias("value"), s.alias("left"), s.alias("right")))), lambda _: F.lit(False))
    holds = F.lit(False)
    for tests in HOLDS:
        every = text.rlike(tests[0])
        for more in tests[1:]:
            every = every & text.rlike(more)
        holds = holds | every
    return F.when(holds, F.transform(F.transform(zipped, one), known)).otherwise(none)


def kind_of(value: Column) -> Column:
    out = F.lit("secret")
    for kind, pattern in reversed(KINDS.items()):
        out = F.when(value.rlike(pattern), kind).otherwise(out)
    return out


def scan(docs: DataFrame, forest: Forest, text: str = "text", path: str | None = None, cut: float = CUT) -> DataFrame:
    """_row, n_candidates, secrets (array of struct(kind, start, end, score)) and redacted of each row of docs."""
    rows = carried(docs)
    whole = F.coalesce(F.col("_row")[text], F.lit(""))
    where = F.col("_row")[path].cast("string") if path else F.lit(None).cast("string")
    rows = rows.select("_row", candidates(whole, where).alias("found"))

    def one(c: Column, end: Column) -> Column:
        kind, points = kind_of(c["value"]), F.round(forest.column(c["numbers"]), 6)
        return F.struct(kind.alias("kind"), (end - F.length(c["value"])).alias("start"), end.alias("end"), points.alias("score"), F.concat(c["gap"], c["head"]).alias("before"), c["value"].alias("value"))

    sizes = F.transform("found", lambda c: F.length(c["gap"]) + F.length(c["head"]) + F.length(c["value"]))
    rows = rows.select("_row", "found", running_sums(sizes).alias("ends"))
    rows = rows.select("_row", F.transform("found", lambda c, i: one(c, F.col("ends")[i])).alias("seen"), F.try_element_at("ends", F.lit(-1)).alias("last"))
    secrets = F.transform(F.filter("seen", lambda s: s["score"] >= cut), lambda s: F.struct(s["kind"], s["start"], s["end"], s["score"]))
    rows = rows.select("_row", F.size("seen").cast("long").alias("n_candidates"), secrets.alias("secrets"), "seen", "last")
    # What stands before each candidate, it or its mark, and the rest after the last one.
    put = F.transform("seen", lambda s: F.concat(s["before"], F.when(s["score"] >= cut, F.concat(F.lit("[SECRET:"), F.upper(s["kind"]), F.lit("]"))).otherwise(s["value"])))
    redacted = F.when(F.size("secrets") == 0, whole).otherwise(F.concat(F.array_join(put, ""), F.substr(whole, F.col("last") + 1)))
    return rows.select("_row", "n_candidates", "secrets", redacted.alias("redacted"))


@lru_cache(1)
def _default_trees(app: str) -> list:
    spark = SparkSession.active()
    return train(made_findings(spark)).trees


def default_forest(spark: SparkSession) -> Forest:
    """The forest of the made findings, grown once a session."""
    return Forest(_default_trees(spark.sparkContext.applicationId))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    spans = F.array_join(F.transform("secrets", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return scan(docs, default_forest(spark), path="source").select(
        F.col("_row.doc_id").alias("doc_id"), "n_candidates", F.size("secrets").cast("long").alias("n_secrets"), spans.alias("spans"), F.sha2("redacted", 256).alias("redacted_sha256"),
    )
