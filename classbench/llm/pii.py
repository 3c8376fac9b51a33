"""Personal data: regular expressions propose, checksums confirm, context words adjust (native).

Everything is a Spark expression: ``regexp_extract_all`` gives the matches of a
kind, ``split`` by the same pattern the text between them, and running sums of
their lengths the positions, so no row is exploded and no text is shuffled.

Defined results: a null text counts as empty (no spans, text ``""``); repeated
rows give repeated results; an empty table gives an empty result; other columns
are passed through, and a column of the input that has the name of an output
column is replaced by it.  Work is linear in the text, however long, as every
pattern is free of backtracking over its own matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classbench.llm.common import let


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    ``hint`` is a cheap test that a text can hold a match at all; ``base``
    kinds keep every confirmed match, the others need ``needed`` as score.
    """

    name: str
    hint: str
    pattern: str
    context: str
    base: bool = True
    prior: float = 0.6
    needed: float = 0.0


#: Patterns, order of kinds and context words.  Possessive loops
#: (``++``) match what the plain ones do, without Java's recursion on long runs;
#: an e-mail's first part cannot start inside a run that has just failed, nor an
#: address inside a run of digits (a match always ends at the end of one).
KINDS = (
    Kind("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "(?i)mail|contact|write|correo|kontakt|courriel", prior=0.9),
    Kind("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "(?i)\\bip\\b|address|host|server|login", prior=0.7),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){13}", r"[0-9](?:[\x20-]?[0-9])++", "(?i)card|visa|credit|karte|tarjeta|carte", prior=0.8),
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", "(?i)phone|call|tel|mobile|fax", prior=0.7),
    Kind("iban", r"[A-Z]{2}[0-9]{2}[\x20]?[A-Z0-9]{4}", r"[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{4}){2,7}(?:[\x20]?[A-Z0-9]{1,3})?",
         "(?i)iban|account|bank|konto|cuenta|compte", base=False, prior=0.7, needed=0.5),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "(?i)ssn|social security|tax id", base=False,
         prior=0.3, needed=0.5),
)
BASE_KINDS = tuple(k.name for k in KINDS if k.base)
#: An octet up to 255, leading zeros allowed, and four of them.
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Context: so many code points before and after a match.
BEFORE, AFTER, CONTEXT_GAIN = 40, 20, 0.25
#: Running sums restart every so many matches, which keeps them near linear.
BLOCK = 128

SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint,text:string,score:double>>"


def _bind(value: str, name: str, body: str) -> str:
    """SQL text of ``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def luhn_valid(digits: str) -> str:
    """Luhn checksum of a string of digits (SQL texts in and out)."""
    doubled = "2 * int(substring(r, i, 1)) - if(int(substring(r, i, 1)) > 4, 9, 0)"
    return _bind(f"reverse({digits})", "r", f"aggregate(sequence(1, length(r)), 0, (s, i) -> "
                 f"s + if(i % 2 = 1, int(substring(r, i, 1)), {doubled})) % 10 = 0")


def mod97_valid(iban: str) -> str:
    """ISO 7064 mod 97-10 of an IBAN without blanks (SQL texts in and out)."""
    turned = f"filter(split(substring({iban}, 5) || substring({iban}, 1, 4), ''), c -> c != '')"
    return (f"aggregate({turned}, 0, (s, c) -> if(c between '0' and '9', (s * 10 + int(c)) % 97, "
            "(s * 100 + ascii(c) - 55) % 97)) = 1")


def confirmed(kind: str, m: str) -> str:
    """SQL test whether a proposed match of ``kind`` passes its validator."""
    if kind == "ip":
        return rf"{m} rlike r'^{OCTET}(?:\.{OCTET}){{3}}$'"
    if kind == "card":
        return _bind(f"translate({m}, ' -', '')", "d", f"if(length(d) between 14 and 19, {luhn_valid('d')}, false)")
    if kind == "phone":
        return f"length(regexp_replace({m}, '[^0-9]', '')) between 10 and 15"
    if kind == "iban":
        return _bind(f"translate({m}, ' ', '')", "b", f"length(b) between 15 and 34 and {mod97_valid('b')}")
    return "true"


def _starts(step: str) -> str:
    """SQL of the running sums of an array of longs, block by block."""
    total = "aggregate(slice({0}, {1}, {2}), 0L, (x, y) -> x + y)".format
    blocks = f"int(ceil(size({step}) / {BLOCK}.0)) - 1"
    sums = f"transform(sequence(0, {blocks}), b -> {total(step, f'b * {BLOCK} + 1', BLOCK)})"
    before = f"transform(bs, (x, b) -> {total('bs', 1, 'b')})"
    own = total(step, f"(i div {BLOCK}) * {BLOCK} + 1", f"i % {BLOCK} + 1")
    return _bind(sums, "bs", _bind(before, "bb", f"transform({step}, (x, i) -> get(bb, int(i div {BLOCK})) + "
                                                 f"{own.replace('(i div', 'int(i div')})"))


def kind_spans(text: str, kind: Kind) -> str:
    """SQL of the confirmed spans of one kind, in order: kind, start, end (code points), text, score."""
    step = "transform(f.m, (x, i) -> bigint(length(get(f.g, i))) + if(i > 0, length(get(f.m, i - 1)), 0))"
    near = (f"(right(get(f.g, i), {BEFORE}) rlike r'{kind.context}' or "
            f"left(get(f.g, i + 1), {AFTER}) rlike r'{kind.context}')")
    score = f"least(1.0D, {kind.prior}D + if({near}, {CONTEXT_GAIN}D, 0.0D))"
    span = (f"if({confirmed(kind.name, 'm')}, named_struct('kind', '{kind.name}', 'start', get(at, i), "
            f"'end', get(at, i) + length(m), 'text', m, 'score', {score}), null)")
    kept = f"filter(transform(f.m, (m, i) -> {span}), s -> s is not null and s.score >= {kind.needed}D)"
    located = _bind(_bind("f.m", "ms", step.replace("f.m", "ms")), "st", _bind(_starts("st"), "at", kept))
    found = _bind(f"named_struct('m', regexp_extract_all({text}, r'{kind.pattern}', 0), "
                  f"'g', split({text}, r'{kind.pattern}', -1))", "f", f"if(size(f.m) > 0, {located}, null)")
    hint = f"contains({text}, '@')" if kind.hint == "@" else f"{text} rlike r'{kind.hint}'"
    return f"cast(coalesce(if({hint}, {found}, null), array()) as {SPAN_TYPE})"


def find_pii(df: DataFrame, text_col: str = "text", out: str = "pii_spans") -> DataFrame:
    """Add ``out``: all confirmed spans of all kinds, by start and then kind as listed."""
    text = f"coalesce(`{text_col}`, '')"
    ranked = [f"transform({kind_spans(text, k)}, s -> named_struct('start', s.start, 'rank', {i}, 'span', s))"
              for i, k in enumerate(KINDS)]
    return df.withColumn(out, F.expr(f"transform(array_sort(concat({', '.join(ranked)})), x -> x.span)"))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span, overlapping ones merged, replaced by ``[KIND]`` of its first one."""
    part = "array<struct<kind:string,start:bigint,end:bigint>>"

    def merge(done, s):
        last = F.element_at(done, -1)
        fresh = F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        longer = F.struct(last["kind"].alias("kind"), last["start"].alias("start"),
                          F.greatest(last["end"], s["end"]).alias("end"))
        apart = (F.size(done) == 0) | (s["start"] >= F.try_element_at(done, F.lit(-1))["end"])
        return F.when(apart, F.concat(done, F.array(fresh))).otherwise(
            F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer)))

    merged = F.aggregate(spans, F.array().cast(part), merge)

    def rebuilt(m):
        pieces = F.transform(m, lambda s, i: let(
            F.when(i > 0, F.get(m, i - 1)["end"]).otherwise(F.lit(0).cast("bigint")),
            lambda at: F.concat(F.substring(text, (at + 1).cast("int"), (s["start"] - at).cast("int")),
                                F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        tail = F.substring(text, (F.element_at(m, -1)["end"] + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(pieces, ""), tail)

    return F.when(F.size(spans) == 0, text).otherwise(let(merged, rebuilt))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_pii(spark, sf_dir) -> DataFrame:
    """Every document's spans: counts by kind, digest of the base spans, all spans."""
    from classbench.llm.common import read_table

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("pii_spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    found = find_pii(docs).select("doc_id", "pii_spans")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(span_list(F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))), 256).alias("base_sha256"),
        span_list(spans).alias("spans"))
