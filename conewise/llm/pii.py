r"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

Every kind has a pattern, a validator (parts of an address, the Luhn sum of a
card, the number of digits of a phone, mod-97 of an IBAN) and a starting score.
A confirmed checksum raises the score, and so do words that stand within
``CONTEXT`` characters of the text, other matches included.  The four base kinds (email, ip, card, phone) are always
reported if valid; the others need a score of ``THRESHOLD``.

The patterns match leftmost and without overlap within a kind.  They are
written with possessive repeats and look-behinds that change no match, so that a
long run of digits or letters is read once and no repeat grows the stack.
Places come from the text between the matches: the lengths before a match are
summed by a window over the document's matches, of which there may be any
number.  Places count code points, the end is exclusive.

Only DataFrame functions are used, and one scan: each document gives one row
without its text and one for each proposal.

Defined cases: null texts are empty; equal rows are reported one by one; no
spans give the empty string (and its hash); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conewise.llm.common import plain_text, read_table

CONTEXT = 40
THRESHOLD = 0.7


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # a text without this cannot match
    valid: Callable[[Column], Column]
    score: float
    least: int  # characters of the shortest match
    context: list[str] = field(default_factory=list)
    base: bool = True

    @property
    def mask(self) -> str:
        return f"[{self.name.upper()}]"

    def scored(self, before: Column, after: Column) -> Column:
        """The starting score, more with context words nearby."""
        if not self.context:
            return F.lit(self.score)
        near = rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{'|'.join(self.context)})(?![\p{{L}}\p{{N}}])"
        return F.least(F.lit(1.0), F.lit(self.score) + F.when(F.concat(before, F.lit(" "), after).rlike(near), 0.4).otherwise(0.0))

    def accepted(self, hit: Column, before: Column, after: Column) -> Column:
        ok = F.coalesce(self.valid(hit), F.lit(False))
        return ok if self.base else ok & (self.scored(before, after) >= THRESHOLD)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _ip(hit: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _luhn(hit: Column) -> Column:
    def total(d: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
            return acc + F.when(i % 2 == 0, x).otherwise(F.when(x > 4, 2 * x - 9).otherwise(2 * x))

        many = F.length(d).between(12, 19)
        return many & (F.when(many, F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add)) % 10 == 0)

    return F.transform(F.array(_digits(hit)), total)[0]


def _phone(hit: Column) -> Column:
    return F.length(_digits(hit)).between(9, 15)


def _mod97(hit: Column) -> Column:
    packed = F.regexp_replace(hit, " ", "")
    turned = F.concat(F.substring(packed, F.lit(5), F.length(packed)), F.substring(packed, 1, 4))

    def add(acc: Column, c: Column) -> Column:
        code = F.ascii(c)  # letters count as 10 to 35
        return F.when(code < 65, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.length(packed).between(15, 34) & (F.aggregate(F.split(turned, ""), F.lit(0), add) == 1)


def _ssn(hit: Column) -> Column:
    return ~hit.rlike("^(?:000|666|9..)-") & ~hit.rlike("-00-") & ~hit.rlike("-0000$")


_LOCAL = r"[A-Za-z0-9._%+-]"
KINDS = [
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", lambda h: F.lit(True), 0.9, 5),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", _ip, 0.6, 7, ["ip", "address", "host", "server"]),
    # a chain of at least twelve digits, each after at most one space or hyphen
    Kind("card", r"[0-9](?:[ -]?[0-9]){11,}+", "[0-9][ -]?[0-9]", _luhn, 0.8, 12, ["card", "visa", "mastercard", "credit", "karte", "carte"]),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", _phone, 0.7, 4, ["phone", "tel", "call", "mobile", "fax"]),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         "[A-Z]{2}[0-9]{2}", _mod97, 0.8, 12, ["iban", "bank", "account", "konto", "compte", "cuenta"], base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]", _ssn, 0.3, 11,
         ["ssn", "social", "security"], base=False),
]


def _may_match(kind: Kind, text: Column) -> Column:
    return F.contains(text, F.lit(kind.hint)) if kind.hint == "@" else text.rlike("[0-9]") & text.rlike(kind.hint)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), use)[0]


def _parts(kind: Kind, text: Column) -> Column:
    """The text around the matches, the matches, and the ends of both that contexts are made of."""
    def ended(p: Column) -> Column:
        gaps, hits = p["gaps"], p["hits"]
        last, first = lambda c: F.right(c, F.lit(CONTEXT)), lambda c: F.left(c, F.lit(CONTEXT))
        tails = F.transform(hits, lambda hit, j: last(F.concat(last(F.get(gaps, j)), last(hit))))
        heads = F.transform(hits, lambda hit, j: first(F.concat(first(hit), first(F.get(gaps, j + 1)))))
        return F.struct(gaps.alias("gaps"), hits.alias("hits"), tails.alias("tails"), heads.alias("heads"))

    return _bound(F.struct(F.split(text, kind.pattern, -1).alias("gaps"),
                           F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("hits")), ended)


def _around(kind: Kind, p: Column, i: Column) -> tuple[Column, Column]:
    """The ``CONTEXT`` characters of the text before and after match ``i``, over as many other matches as fit in them."""
    many = -(-CONTEXT // kind.least)
    before = F.slice(p["tails"], F.greatest(i - many, F.lit(0)) + 1, F.least(i, F.lit(many)))
    after = F.slice(p["heads"], i + 2, F.lit(many))
    return (F.right(F.concat(F.array_join(before, ""), F.right(F.get(p["gaps"], i), F.lit(CONTEXT))), F.lit(CONTEXT)),
            F.left(F.concat(F.left(F.get(p["gaps"], i + 1), F.lit(CONTEXT)), F.array_join(after, "")), F.lit(CONTEXT)))


def _proposals(number: int, kind: Kind, text: Column) -> Column:
    def rows(p: Column) -> Column:
        gaps = p["gaps"]

        def row(hit: Column, i: Column) -> Column:
            before, after = _around(kind, p, i)
            return F.struct(
                F.lit(number).alias("kind"), i.alias("i"), F.length(F.get(gaps, i)).cast("long").alias("gap"),
                F.length(hit).cast("long").alias("size"), kind.accepted(hit, before, after).alias("accepted"),
                kind.scored(before, after).alias("score"))

        return F.transform(p["hits"], row)

    none = F.expr("cast(array() as array<struct<kind:int,i:int,gap:bigint,size:bigint,accepted:boolean,score:double>>)")
    return F.when(_may_match(kind, text), _bound(_parts(kind, text), rows)).otherwise(none)


def find(docs: DataFrame) -> DataFrame:
    """One row per document (doc_id, row) with ``found``: its accepted spans as sorted
    structs (start, kind number, end, score)."""
    text = F.col("text")
    proposed = (
        docs.select(F.col("doc_id").cast("long"), plain_text().alias("text"), F.monotonically_increasing_id().alias("row"))
        .select("row", "doc_id", F.explode_outer(F.concat(*[_proposals(n, k, text) for n, k in enumerate(KINDS)])).alias("p"))
        .select("row", "doc_id", "p.*")
    )
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = proposed.repartition("row").withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
    span = F.when(F.col("accepted"), F.struct((F.col("end") - F.col("size")).alias("start"), "kind", "end", "score"))
    return placed.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(span)).alias("found"))


def _listed(found: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _masked(kind: Kind, text: Column) -> Column:
    def replaced(p: Column) -> Column:
        hits, gaps = p["hits"], p["gaps"]

        def piece(gap: Column, i: Column) -> Column:
            hit = F.get(hits, i)
            ok = kind.accepted(hit, *_around(kind, p, i))
            return F.concat(gap, F.when(i < F.size(hits), F.when(ok, F.lit(kind.mask)).otherwise(hit)).otherwise(""))

        return F.array_join(F.transform(gaps, piece), "")

    return _bound(text, lambda t: F.when(_may_match(kind, t), _bound(_parts(kind, t), replaced)).otherwise(t))


def mask(text: Column) -> Column:
    """The text with each accepted span replaced by its kind in brackets, kind by kind."""
    by_name = {k.name: k for k in KINDS}
    # wide kinds first: parts of an e-mail are no address; a mask can end a run of digits, so numbers are looked for again
    for name in ("email", "phone", "iban", "card", "ip", "ssn", "phone", "card", "ip"):
        text = _masked(by_name[name], text)
    return text


def _is(n: int) -> Callable[[Column], Column]:
    return lambda kind: kind == n


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("found")
    base = F.filter(found, lambda s: s["kind"] < 4)
    counts = [F.size(F.filter(found["kind"], _is(n))).cast("long").alias(f"n_{KINDS[n].name}") for n in range(4)]
    return find(read_table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(found).alias("spans"),
        F.transform(found, lambda s: s["score"]).alias("scores"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with personal data masked in ``text``; ``n_chars`` follows the new text."""
    masked = docs.withColumn("text", F.when(F.col("text").isNotNull(), mask(plain_text())))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return masked
