"""Personal data by weak supervision.

Patterns propose spans; labelers (form, checksum, gazetteer, context, border)
vote on each or abstain.  The patterns of votes are counted over all rows, at
most kinds * 3 ** labelers groups, and expectation-maximisation over these
counts estimates how each labeler votes on true and false spans.  The posterior
of every span then trains the final classifier, naive Bayes over features of a
span, from sums over all rows.  Spans that fit a strict pattern and its check
(``base``) always stay, spans that fail their check never do; the classifier
decides on the others, as on loose forms that have no strict check to fail.

Offsets are code points, the end exclusive.  Strict patterns are matched from
the left without overlap, per kind; a match that fails its check is dropped and
only remains a proposal.  Every scan is linear in the text.

Defined results: a null text is an empty one without spans; repeated rows have
equal results; an empty table gives an empty table and the prior beliefs; all
columns of the input are kept and the added ones take unused names.
"""
from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm.common import fresh, written

#: in the order of the output
KINDS = ("email", "ip", "card", "phone", "name", "secret", "ssn")
LABELERS = ("form", "check", "gazetteer", "context", "border")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is tried once, from its first digit
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
LOOSE = {
    "phone": re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    "secret": re.compile(r"(?<![0-9A-Za-z])(?=[a-f]*[0-9])[0-9a-f]{32,}+(?![0-9A-Za-z])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
}
NAME = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.? [A-ZÀ-Þ][a-zà-ÿ]+(?: [A-ZÀ-Þ][a-zà-ÿ]+)?")
HIDDEN = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]{1,63})+")
#: the last part of a written-out domain
ENDING = re.compile(r"[\x20)\]][A-Za-z]{2,}\Z")
#: card numbers of less than 16 digits
ISSUED = re.compile(r"4[0-9]{12}|3[068][0-9]{12}|3[47][0-9]{13}")

ENDINGS = frozenset("com net org edu gov mil int info io co de fr es it uk us eu nl be ch at ca au jp cn in br ru".split())
NAMES = frozenset("""james mary john patricia robert jennifer michael linda david elizabeth william barbara richard susan joseph
jessica thomas sarah charles karen anna peter hans klaus ursula monika pierre marie jean sophie juan carmen jose lucia""".split())
CUES = {
    "email": "mail contact write", "ip": "ip address host server ping login", "card": "card visa mastercard credit pay iban account",
    "phone": "call phone tel mobile fax whatsapp dial", "name": "name dear signed by", "secret": "token key secret password api auth bearer",
    "ssn": "ssn social security",
}
CUE = {k: re.compile(rf"\b(?:{'|'.join(v.split())})", re.I) for k, v in CUES.items()}
AGAINST = re.compile(r"\b(?:version|ver|v|section|chapter|isbn|order|part|figure|build|release)\b\W*$", re.I)
#: characters before a span that the context labeler reads
CONTEXT = 32


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """Each match holds one @ sign, so go from one to the next and take the
    local part to its left, but nothing of the match before."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end(), True
            done = m.end()
        at = text.find("@", max(done, at + 1))


def ips(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        yield m.start(), m.end(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def cards(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19:
                yield m.start(), m.end(), len(digits) >= 16 and luhn(digits)


def phones(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in PHONE.finditer(text):
        yield m.start(), m.end(), 8 <= sum(c.isdigit() for c in m.group()) <= 15


def proposals(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) of all spans that a pattern finds."""
    found: list[tuple[int, int, int, bool]] = []
    if "@" in text:
        found += [(0, *x) for x in emails(text)]
    if DIGIT.search(text):
        found += [(1, *x) for x in ips(text)] if "." in text else []
        found += [(2, *x) for x in cards(text)]
        found += [(3, *x) for x in phones(text)] if "+" in text else []
        for kind, pattern in LOOSE.items():
            found += [(KINDS.index(kind), m.start(), m.end(), False) for m in pattern.finditer(text)]
    found += [(4, m.start(), m.end(), False) for m in NAME.finditer(text)]
    if "(at" in text or "[at" in text or "(AT" in text or "[AT" in text:
        found += [(0, m.start(), m.end(), False) for m in HIDDEN.finditer(text)]
    return found


def checked(name: str, span: str, digits: str, base: bool) -> int:
    """The check's vote: no only if the span's own form has a check that it fails.
    A mail address without @ is checked by its ending, a phone number without +
    by the digits that an area and an exchange begin with; both abstain where
    these do not fit, and so does a card number below 16 digits that fits Luhn but
    no issuer's form."""
    if base:
        return 1
    if name == "email":
        return 1 if ENDING.search(span) else -1
    if name == "phone" and span[0] != "+":
        return 1 if digits[0] > "1" and digits[3] > "1" else -1
    if name == "card" and luhn(digits):
        return 1 if ISSUED.fullmatch(digits) else -1
    return 0


def votes(text: str, kind: int, start: int, end: int, base: bool) -> list[int]:
    """1: personal data, 0: not, -1: abstains; in the order of LABELERS."""
    name, span, before = KINDS[kind], text[start:end], text[max(0, start - CONTEXT):start]
    digits = re.sub(r"[^0-9]", "", span[:64])
    form = 1 if base else -1
    check = -1
    if name in ("email", "ip", "card", "phone"):
        check = checked(name, span, digits, base)
    if name == "ssn":
        check = 0 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" else 1
    if name == "secret":
        check = 1 if len(set(span)) >= 8 else 0
    gazetteer = -1
    if name == "email":
        gazetteer = 1 if re.split(r"[. )\]]", span[-16:])[-1].lower() in ENDINGS else -1
    elif name == "ip":
        gazetteer = 0 if span.startswith(("0.", "127.", "255.")) else -1
    elif name == "card":
        gazetteer = 1 if digits[0] in "3456" else -1
    elif name == "name":
        gazetteer = 1 if any(w.lower() in NAMES for w in span.split()) else -1
    context = 1 if CUE[name].search(before) else 0 if AGAINST.search(before) else -1
    glued = (start > 0 and text[start - 1].isalnum() and text[start].isalnum()) or (end < len(text) and text[end].isalnum())
    return [form, check, gazetteer, context, 0 if glued else 1]


def side(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


#: values of one feature
VALUES = 10


def features(text: str, kind: int, start: int, end: int, by: list[int]) -> list[int]:
    span = text[start:end]
    values = [kind, min(9, int(math.log2(end - start))), min(9, 10 * sum(c.isdigit() for c in span) // len(span)),
              side(text[start - 1:start]), side(text[end:end + 1]), *[v + 1 for v in by]]
    return [VALUES * i + v for i, v in enumerate(values)]


N_FEATURES = VALUES * (5 + len(LABELERS))
SPAN = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                     T.StructField("base", T.BooleanType()), T.StructField("votes", T.ArrayType(T.IntegerType())),
                     T.StructField("features", T.ArrayType(T.IntegerType()))])
ARROW_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
                                 ("votes", pa.list_(pa.int32())), ("features", pa.list_(pa.int32()))]))


def spans_of(text: str) -> list[dict]:
    out = []
    for kind, start, end, base in sorted(proposals(text), key=lambda x: (x[0], x[1], -x[2], not x[3])):
        by = votes(text, kind, start, end, base)
        out.append({"kind": kind, "start": start, "end": end, "base": base, "votes": by, "features": features(text, kind, start, end, by)})
    return out


def mapped(df: DataFrame, text: str, name: str, kind: T.DataType, arrow: pa.DataType, f: Callable, *more: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with a column f(text, *more), a null text as an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            args = [b.column(b.schema.get_field_index(c)).to_pylist() for c in more]
            texts = [t or "" for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            made = pa.array([f(*x) for x in zip(texts, *args)], arrow)
            left = [i for i, c in enumerate(b.schema.names) if c not in drop and c != name]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in left], made], names=[*[b.schema.names[i] for i in left], name])

    fields = [x for x in df.schema.fields if x.name not in drop and x.name != name]
    return df.mapInArrow(run, T.StructType([*fields, T.StructField(name, kind)]))


#: before a vote is seen: the share of true spans; how often a labeler says no,
#: yes and nothing on false (0) and on true spans (1); and the weight of these
#: beliefs as a share of all spans
PRIOR_TRUE, PRIOR_WEIGHT = 0.5, 0.05
PRIOR_VOTES = ((0.45, 0.1, 0.45), (0.05, 0.5, 0.45))
ROUNDS = 100


def posterior(v: tuple[int, ...], true: float, says: list) -> float:
    x = math.log(true / (1 - true)) + sum(math.log(by[1][k] / by[0][k]) for k, by in zip(v, says))
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def estimate(counts: dict[tuple[int, tuple[int, ...]], int]) -> tuple[dict[int, float], list]:
    """EM over {(kind, votes): count}: the share of true spans of each kind, and
    how each labeler votes on false and true spans."""
    total = sum(counts.values())
    weight = PRIOR_WEIGHT * total
    kinds = {k: PRIOR_TRUE for k in range(len(KINDS))}
    says = [[[*PRIOR_VOTES[y]] for y in (0, 1)] for _ in LABELERS]
    rows = sorted(counts.items())
    for _ in range(ROUNDS if total else 0):
        posts = [posterior(v, kinds[k], says) for (k, v), _ in rows]
        for kind in kinds:
            own = [(p, n) for p, ((k, _), n) in zip(posts, rows) if k == kind]
            of = sum(n for _, n in own) * PRIOR_WEIGHT + 1
            kinds[kind] = (sum(p * n for p, n in own) + PRIOR_TRUE * of) / (sum(n for _, n in own) + of)
        for j in range(len(LABELERS)):
            for y in (0, 1):
                seen = [weight * p for p in PRIOR_VOTES[y]]
                for p, ((_, v), n) in zip(posts, rows):
                    seen[v[j]] += n * (p if y else 1 - p)
                says[j][y] = [x / sum(seen) for x in seen]
    return kinds, says


def classifier(spans: DataFrame) -> list[float]:
    """Weights of the features (the last is the constant) by naive Bayes on the
    posteriors.  ``spans`` has a row for every span; what reaches the driver is
    bounded by kinds * 3 ** labelers and by the number of features."""
    counted = spans.groupBy("kind", "votes").count().collect()
    index = {-1: 2, 0: 0, 1: 1}
    counts = {(r["kind"], tuple(index[v] for v in r["votes"])): r["count"] for r in counted}
    kinds, says = estimate(counts)
    logit = F.element_at(F.lit([math.log(kinds[k] / (1 - kinds[k])) for k in range(len(KINDS))]), F.col("kind") + 1)
    for j, by in enumerate(says):
        logs = [math.log(by[1][k] / by[0][k]) for k in range(3)]
        logit = logit + F.when(F.col("votes")[j] == 1, logs[1]).when(F.col("votes")[j] == 0, logs[0]).otherwise(logs[2])
    true = 1 / (1 + F.exp(-logit))
    # rounded, so that the order of adding cannot show in the weights
    sums = (spans.select(true.alias("p"), F.explode("features").alias("f")).groupBy("f")
            .agg(F.sum(F.round("p", 6).cast("decimal(18,6)")).alias("yes"), F.count("*").alias("n")).collect())
    yes, no = [1.0] * N_FEATURES, [1.0] * N_FEATURES
    for r in sums:
        yes[r["f"]] += float(r["yes"])
        no[r["f"]] += r["n"] - float(r["yes"])
    groups = [range(i, i + VALUES) for i in range(0, N_FEATURES, VALUES)]
    all_yes, all_no = (sum(x[i] for i in groups[0]) for x in (yes, no))
    weights = [0.0] * N_FEATURES
    for g in groups:
        a, b = sum(yes[i] for i in g), sum(no[i] for i in g)
        for i in g:
            weights[i] = math.log(yes[i] / a) - math.log(no[i] / b)
    return [*weights, math.log(all_yes / all_no)]


def found(df: DataFrame, text: str = "text", name: str = "pii", keep_text: bool = True) -> DataFrame:
    """``df`` with the spans of every text: an array of (kind, start, end, base).

    Rows with their proposals are written once; both counts and the decision
    read them.  Spans that the classifier adds do not overlap one of their kind.
    """
    spans = fresh(df, "spans")
    rows = written(mapped(df, text, spans, T.ArrayType(SPAN), ARROW_SPAN, spans_of, drop=() if keep_text else (text,)), "pii")
    weights = classifier(rows.select(F.explode(spans).alias("s")).select("s.*"))
    score = lambda s: F.aggregate(s["features"], F.lit(weights[-1]), lambda a, f: a + F.element_at(F.lit(weights[:-1]), f + 1))
    kept = F.filter(spans, lambda s: s["base"] | ((score(s) > 0) & (s["votes"][LABELERS.index("check")] != 0) & ~F.exists(spans, lambda b: b["base"] & (b["kind"] == s["kind"]) & (b["start"] < s["end"]) & (s["start"] < b["end"]))))
    return rows.withColumn(name, F.when(F.size(spans) > 0, F.transform(kept, lambda s: F.struct(s["kind"], s["start"], s["end"], s["base"]))).otherwise(
        F.expr("CAST(array() AS array<struct<kind: int, start: int, end: int, base: boolean>>)"))).drop(spans)


def redacted(text: str, spans: list[dict]) -> str:
    """Spans replaced by their kind; overlapping ones become one, named after the first."""
    out, done, held = [], 0, None
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"], s["kind"])):
        if held and s["start"] < held[1]:
            held[1] = max(held[1], s["end"])
            continue
        if held:
            out += [text[done:held[0]], f"[{KINDS[held[2]].upper()}]"]
            done = held[1]
        held = [s["start"], s["end"], s["kind"]]
    if held:
        out += [text[done:held[0]], f"[{KINDS[held[2]].upper()}]"]
        done = held[1]
    return "".join([*out, text[done:]])


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with all spans masked in its texts; a null text stays null."""
    pii, masked = fresh(df, "pii"), fresh(df, "masked")
    rows = mapped(found(df, text, pii), text, masked, T.StringType(), pa.string(), redacted, pii, drop=(pii,))
    return rows.select(*[F.when(F.col(c).isNotNull(), F.col(masked)).alias(c) if c == text else F.col(f"`{c}`") for c in df.columns])


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined; the spans come by kind, then start."""
    names = F.lit(list(KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: int) -> Column:
    # a lambda of two parameters would get the place in the array as the second
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = found(docs, keep_text=False)
    base = F.filter("pii", lambda s: s["base"])
    return rows.select("doc_id", *[counted(base, k).alias(f"n_{KINDS[k]}") for k in range(4)],
                       F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"))
