"""Secret scan with a random forest that removes false positives. DataFrame functions only.

A pattern finds candidates: values behind a telling name (quoted ones up to the closing quote or a
space), private-key blocks up to their END line, passwords in URLs, and unbroken runs of key
characters with a digit. A forest judges each by its length, character transitions, classes and
variety, by how much of it known words cover, by whether it looks like a path, and by the words
around it; a whole private-key block is a secret by its form. The forest is fitted by Spark ML on labelled findings and written out as SQL conditions,
so texts are scanned, judged and redacted row by row, without a join and without Python.

No given table labels findings, so :func:`labelled_findings` makes ``LABELLED_ROWS`` of them from
templates (a bounded sample by this parameter); hand in your own to :func:`fit` where you have them.

Defined cases: NULL and empty texts have no candidates (:func:`redact` keeps NULL as NULL); repeated
rows are scanned one by one; two candidates never overlap, the first one wins; an empty table gives
no findings; columns of the same names as the scan's own don't matter and pass through ``redact``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zilverspoor.llm.common import fresh, kept, settled

#: Labelled findings that the forest is fitted on.
LABELLED_ROWS = 4800
TREES, DEPTH = 24, 6
#: Share of trees from which on a candidate is a secret.
VOTES = 0.5

NAMES = (
    r"(?i:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key"
    r"|auth[_-]?key|credentials?)"
)
ASSIGNED = NAMES + r"""["']?\s{0,3}[:=]\s{0,3}["']?"""
KEY_CHARS = r"[A-Za-z0-9+/_-]"
#: What stands before the password in a URL, from the scheme's end.
LOGIN = r"""://[^\s/:@"'<>]{0,64}:"""
#: What a candidate may begin with that is not part of its value.
LEAD = rf"^(?:{ASSIGNED}|{LOGIN})"
_KEY = r"[A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
#: Up to the END line, if no other block begins before; else header lines and what has no hyphen.
BLOCK = (
    rf"-----BEGIN {_KEY}(?:(?>[\s\S]*?-----(?=(?:BEGIN|END) {_KEY}))END {_KEY}"
    r"|(?:\s{0,4}[A-Za-z][A-Za-z-]{0,40}: [^\n]{0,200}){0,8}[^-]*)"
)
_NEXT = r"[,;]{1,9}[\w.-]{1,40}[:=]"
#: Commas and semicolons belong to a value unless it ends there or another name follows.
PLAIN = (
    rf"""(?![^\s"'<>,;]{{0,5}}{_NEXT})[^\s"'<>]{{5,}}?[^\s"'<>,;]"""
    rf"""(?=[,;]*(?:[\s"'<>]|\z)|{_NEXT})"""
)
CANDIDATE = "|".join(
    (
        rf"(?:{ASSIGNED})?{BLOCK}",
        ASSIGNED + rf"""(?:(?<=")[^\s"]{{6,}}(?=")|(?<=')[^\s']{{6,}}(?=')|{PLAIN})""",
        LOGIN + r"""[^\s/"'<>]{3,256}(?=@)""",
        rf"(?<!{KEY_CHARS})(?=[A-Za-z+/_-]*[0-9]){KEY_CHARS}{{12,}}={{0,2}}",
    )
)

# Fixed word lists
#: Prefixes of keys that public services hand out.
KEY_PREFIXES = "AKIA ASIA ghp_ gho_ ghs_ github_pat_ glpat- sk_live_ rk_live_ sk- xoxb- xoxp- AIza npm_ hf_ SG."
#: Words of a dictionary that secrets do not consist of.
DICTIONARY = (
    "example sample dummy placeholder changeme change your mine here test testing fake none null "
    "redacted secret password passwd token value string user name admin default required optional "
    "file path index module package version build release config setting server client service "
    "handler manager controller request response session database table column number group "
    "class object method function return import export public private static final begin end "
    "chapter section introduction appendix figure page part north south street road "
    "januar februar march april june july august september october november december "
    "monday tuesday wednesday thursday friday saturday sunday usr lib bin home var local share "
    "include python java node modules dist site src main http https www com org net html json "
    "image photo report summary draft copy final backup archive asdf qwerty letmein welcome"
).split()
SECRET_NEAR = r"(?i)(?:password|passwd|pwd|passphrase|secret|token|api.?key|access.?key|auth|credential|bearer|key)"
OTHER_NEAR = r"(?i)(?:sha-?\d*|md5|commit|checksum|digest|hash|etag|revision|uuid|guid|order|invoice|phone|tel|isbn|version|example|sample|serial|http|www|file|path|page)"


def features(match: Column, before: Column, after: Column) -> dict[str, Column]:
    """Numbers that describe a candidate; ``match`` may begin with the name it is assigned to."""
    value = F.regexp_replace(match, LEAD, "")
    lead = F.concat(before, F.substring(match, 1, 64))
    n = F.greatest(F.length(value), F.lit(1))
    count = lambda pattern: F.regexp_count(value, F.lit(pattern)).cast("double")
    share = lambda pattern: count(pattern) / n
    flag = lambda condition: F.coalesce(condition.cast("double"), F.lit(0.0))
    words = "(?i)" + "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    uncovered = F.length(F.regexp_replace(value, words, ""))
    prefixes = "^(?:" + "|".join(re.escape(p) for p in KEY_PREFIXES.split()) + ")"
    return {
        "length": n.cast("double"),
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "lowers": share("[a-z]"),
        "marks": share("[^A-Za-z0-9]"),
        "to_digit": share("(?<=[A-Za-z])[0-9]"),
        "to_letter": share("(?<=[0-9])[A-Za-z]"),
        "case_turns": share("(?<=[a-z])[A-Z]"),
        "repeats": share(r"(.)(?=\1)"),
        "variety": F.size(F.array_distinct(F.split(value, ""))) / n,
        "hex_only": flag(value.rlike("^[0-9a-fA-F]+$")),
        "uuid": flag(value.rlike("(?i)^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$")),
        "vowels": share("(?i)[aeiou]"),
        "dictionary": (n - uncovered) / n,
        "slashes": share("/"),
        "rooted": flag(value.rlike("^/|^[A-Za-z0-9_-]+/[A-Za-z0-9_-]+/")) + flag(before.rlike(r"[./:\\]$")),
        "extension": flag(after.rlike(r"^\.[a-z]{2,4}\b")),
        "key_prefix": flag(value.rlike(prefixes)),
        "key_block": flag(value.startswith("-----BEGIN")),
        "assigned": flag(F.length(value) < F.length(match)),
        "login": flag(match.startswith("://")),
        "quoted": flag(after.rlike("""^["']""")),
        "call": flag(after.rlike(r"^[(.\[]") | value.rlike(r"[(\[{$]")),
        "secret_near": flag(lead.rlike(SECRET_NEAR)),
        "other_near": flag(before.rlike(OTHER_NEAR)),
    }


# Labelled findings


def _draws(ids: DataFrame) -> DataFrame:
    """Columns of random characters of several kinds, which depend on the row's id only."""
    digest = F.concat(*[F.sha2(F.concat_ws("/", F.col("id"), F.lit(i)), 256) for i in range(6)])
    drawn = ids.select("id", digest.alias("hex")).withColumn(
        "mixed", F.regexp_replace(F.base64(F.unhex("hex")), r"[\s+/=]", "")
    )
    return drawn.select(
        "id", "hex", "mixed",
        F.translate("hex", "abcdef", "273950").alias("digits"),
        F.upper("mixed").alias("upper"),
        F.lower(F.regexp_replace("mixed", "[0-9]", "e")).alias("letters"),
    )


def _random(kind: str, length: int, salt: str) -> Column:
    """Some of a row's random characters; the salt says where they begin."""
    return F.substring(kind, 1 + 3 * (ord(salt) - ord("A")), length)


def _templates() -> list[tuple[int, Column]]:
    """Label and line of each template; the candidate in a line is what the pattern finds."""
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    r = _random
    secret = [
        text("set password=", r("hex", 18, "a"), " for now"),
        text("the password: ", r("mixed", 14, "b"), " was sent"),
        text("a ", 'token = "', r("hex", 40, "c"), '" then'),
        text("token=", r("mixed", 32, "d"), " and so"),
        text("client_secret: '", r("mixed", 28, "e"), "'"),
        text("api_key=", r("mixed", 32, "f"), "&x"),
        text("word AKIA", r("upper", 16, "g"), " word"),
        text("at the end AKIA", r("upper", 16, "h")),
        text("use ghp_", r("mixed", 36, "i"), " to log in"),
        text("STRIPE sk_live_", r("mixed", 24, "j"), "\n"),
        text("bot xoxb-", r("digits", 11, "k"), "-", r("mixed", 24, "k"), " word"),
        text("maps AIza", r("mixed", 35, "l"), " word"),
        text("-----BEGIN RSA PRIVATE KEY-----\n", r("mixed", 60, "m"), "\n-----END RSA PRIVATE KEY-----"),
        text("Authorization: Bearer ", r("mixed", 40, "n")),
        text("secret ", r("mixed", 30, "o"), " word"),
        text('access_key: "', r("upper", 20, "p"), '"'),
        text("pwd = ", r("hex", 24, "q"), "\n"),
        text("passwd=", r("mixed", 10, "r"), " x"),
        text("postgres://app:", r("mixed", 9, "A"), "@db.local/x"),
        text("at https://", r("letters", 6, "B"), ":", r("letters", 6, "C"), r("digits", 2, "C"), "@git.local"),
        text("password=", r("mixed", 5, "D"), ",", r("mixed", 9, "E"), " x"),
        text('secret: "', r("mixed", 8, "F"), ";", r("mixed", 8, "G"), '"'),
        text("-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,", r("upper", 32, "H"), "\n\n", r("mixed", 200, "A"), "\n-----END RSA PRIVATE KEY-----"),
        text("-----BEGIN PGP PRIVATE KEY BLOCK-----\n\n", r("mixed", 180, "B"), "\n-----END PGP PRIVATE KEY BLOCK-----"),
    ]
    other = [
        text("commit ", r("hex", 40, "a"), " fixed it"),
        text("sha256 ", r("hex", 64, "b"), " of it"),
        text("md5: ", r("hex", 32, "c"), "\n"),
        text("id ", r("hex", 8, "d"), "-", r("hex", 4, "e"), "-", r("hex", 4, "f"), "-", r("hex", 4, "g"), "-", r("hex", 12, "h"), " word"),
        text("call +1 ", r("digits", 12, "i"), " word"),
        text("word ", r("digits", 16, "j"), " word"),
        text("number ", r("digits", 14, "k"), " word"),
        text("on 2024-", r("digits", 2, "l"), "-", r("digits", 2, "m"), "-", r("digits", 4, "n"), " word"),
        text("see /usr/lib/python3/", r("letters", 8, "o"), "/", r("letters", 6, "p"), ".py"),
        text("src/module", r("digits", 1, "q"), "/", r("letters", 9, "q"), "_test", r("digits", 1, "r"), ".txt"),
        text("in chapter-", r("digits", 2, "s"), "-introduction of"),
        text("https://www.", r("letters", 8, "t"), ".com/", r("letters", 7, "u"), "/page", r("digits", 2, "u"), "?x"),
        text("password=changeme", r("digits", 3, "v"), " word"),
        text("password: your_password_here", r("digits", 1, "w"), " word"),
        text("AKIA", r("upper", 9, "x"), "EXAMPLE", r("digits", 1, "x"), " word"),
        text("token=xxxxxxxxxxxxxxxx", r("digits", 1, "y"), " word"),
        text("token = tokenizer", r("digits", 1, "z"), ".next(", r("letters", 4, "z"), ")"),
        text("secret = ${", r("letters", 8, "A"), "} word"),
        text("password: required for ", r("letters", 6, "B")),
        text("getUser", r("letters", 6, "C"), r("digits", 1, "C"), "Handler here"),
        text("word ", r("letters", 12, "D"), r("digits", 2, "D"), " word"),
        text("figure", r("digits", 3, "E"), "_", r("letters", 9, "E"), " shows"),
        text("checksum=", r("hex", 40, "F"), " word"),
        text("revision ", r("hex", 16, "G"), " word"),
        text("https://user:password@host", r("digits", 2, "I"), ".example.org/"),
        text("ftp://anonymous:example@", r("letters", 6, "J"), ".org"),
    ]
    return [(1, t) for t in secret] + [(0, t) for t in other]


def labelled_findings(spark: SparkSession, rows: int = LABELLED_ROWS) -> DataFrame:
    """Lines with one candidate each and whether it is a secret."""
    lines = [F.struct(F.lit(m).alias("label"), t.alias("text")) for m, t in _templates()]
    ids = spark.range(-(-rows // len(lines)), numPartitions=1)
    each = _draws(ids).select("id", F.explode(F.array(*lines)).alias("line"))
    return each.select("id", "line.*")


# The forest

Node = float | tuple  # a leaf's vote, or (feature, bound, what holds up to it, what holds beyond)


def _node(lines: list[str], names: list[str]) -> Node:
    """A tree from the lines that Spark ML prints it as."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return float(line.split()[-1])
    feature, bound = re.match(r"If \(feature (\d+) <= ([^)]+)\)", line).groups()
    low = _node(lines, names)
    lines.pop(0)  # the line of the other branch
    return names[int(feature)], float(bound), low, _node(lines, names)


def _vote(node: Node, f: Column) -> Column:
    if isinstance(node, float):
        return F.lit(node)
    name, bound, low, high = node
    return F.when(f[name] <= bound, _vote(low, f)).otherwise(_vote(high, f))


def _votes(forest: list[Node], f: Column) -> Column:
    """The share of trees that call a struct of features a secret."""
    total = _vote(forest[0], f)
    for tree in forest[1:]:
        total = total + _vote(tree, f)
    return total / len(forest)


def _found(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))


def _described() -> Column:
    """The candidates in the columns ``found`` and ``gaps`` with their features."""
    around = F.transform(
        "found",
        lambda m, i: F.struct(
            m.alias("match"),
            F.right(F.get("gaps", i), F.lit(48)).alias("before"),
            F.left(F.get("gaps", i + 1), F.lit(24)).alias("after"),
            F.length(F.get("gaps", i)).alias("gap"),
        ),
    )

    def described(c: Column) -> Column:
        named = features(c["match"], c["before"], c["after"])
        return F.struct(
            c["match"].alias("match"),
            F.regexp_replace(c["match"], LEAD, "").alias("value"),
            c["gap"].alias("gap"),
            F.struct(*[v.alias(n) for n, v in named.items()]).alias("f"),
        )

    return F.transform(around, described)


def _scanned(df: DataFrame, text: Column) -> DataFrame:
    """The frame with a text's candidates and what stands between them."""
    found = df.select("*", settled(_found(F.coalesce(text, F.lit("")))).alias("found"))
    return found.withColumn("gaps", F.when(F.size("found") > 0, F.split(text, CANDIDATE)))


def fit(
    findings: DataFrame, text: str = "text", label: str = "label", seed: int = 1
) -> list[Node]:
    """The trees. ``findings`` is a bounded sample: lines whose first candidate has the label."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    lines = findings.select(
        F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").cast("double").alias("label")
    ).filter("label IS NOT NULL AND text IS NOT NULL")
    one = _scanned(lines, F.col("text")).filter(F.size("found") > 0)
    one = one.select("label", _described().alias("c")).select("label", F.col("c")[0]["f"].alias("f"))
    # one partition, as bags must not depend on how rows are dealt out; written once, as fitting
    # reads the rows again and again
    table = kept(one.select("label", "f.*").coalesce(1), "secret-findings").coalesce(1)
    names = table.columns[1:]
    table = VectorAssembler(inputCols=names, outputCol="features").transform(table)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="onethird"
    ).fit(table.select("label", "features"))
    return [
        _node([x for x in tree.toDebugString.splitlines()[1:] if x.strip()], names)
        for tree in forest.trees
    ]


def _judged(forest: list[Node], votes: float) -> Column:
    """The candidates with their votes; a private-key block with its END line has all of them."""
    whole = lambda v: v.startswith("-----BEGIN") & v.contains("-----END ")
    voted = F.transform(
        _described(),
        lambda c: F.struct(
            c["match"].alias("match"), c["value"].alias("value"), c["gap"].alias("gap"),
            F.when(whole(c["value"]), 1.0).otherwise(_votes(forest, c["f"])).alias("votes"),
        ),
    )
    return F.transform(voted, lambda c: c.withField("secret", c["votes"] >= votes))


def scan(
    df: DataFrame, forest: list[Node], key: str = "doc_id", text: str = "text", votes: float = VOTES
) -> DataFrame:
    """One row for each candidate: key, place in the text (in characters), the digest of the value,
    the share of trees, and whether it is a secret."""
    rows = df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    cut = _scanned(rows, F.col("text")).filter(F.size("found") > 0)
    cut = cut.select("key", "row", settled(_judged(forest, votes)).alias("judged"))
    each = cut.select("key", "row", F.posexplode("judged").alias("at", "c"))
    # the candidates of one text, without the text
    until = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("c.gap") + F.length("c.match")).over(until)
    return each.withColumn("stop", stop).select(
        F.col("key").alias(key),
        (F.col("stop") - F.length("c.value")).alias("start"),
        F.col("stop").alias("end"),
        F.sha2(F.col("c.value"), 256).alias("value_sha256"),
        "c.votes",
        "c.secret",
    )


def redact(
    df: DataFrame, forest: list[Node], text: str = "text", mask: str = "[SECRET]", votes: float = VOTES
) -> DataFrame:
    """The frame with secrets masked in the text; other candidates stay as they are."""
    name = fresh(df, "row_")
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
    text_of = F.col(name).getField(text)
    cut = _scanned(whole, text_of)
    cut = cut.withColumn("judged", F.when(F.size("found") > 0, _judged(forest, votes)))
    pieces = F.transform(
        "judged",
        lambda c, i: F.concat(
            F.get("gaps", i),
            F.when(
                c["secret"],
                F.concat(
                    F.left(c["match"], F.length(c["match"]) - F.length(c["value"])), F.lit(mask)
                ),
            ).otherwise(c["match"]),
        ),
    )
    masked = F.concat(F.array_join(pieces, ""), F.element_at("gaps", -1))
    clean = F.when(F.exists("judged", lambda c: c["secret"]), masked).otherwise(text_of)
    return cut.select([
        (clean if c == text else F.col(name).getField(c)).alias(c) for c in df.columns
    ])
