"""Personal data: exact base patterns, and contextual extraction bootstrapped from them.

What the base patterns find are the seeds. The words beside them are lexical patterns. Other
strings that look like identifiers are instances: those of a form that is none (a date, a number
of card length with a wrong check digit) are contrary, the rest unlabelled. Patterns and instances
are the two sides of a graph over the whole corpus, and scores go to and fro on it. A pattern is
scored by its labelled and contrary instances; unlabelled ones say nothing against it, as long as
one instance in twenty is labelled. An instance is scored by all its patterns together; a confident
one beside a trusted pattern becomes a weaker seed itself and supports further patterns. This goes
on until no instance is added, for ROUNDS rounds at most. Every occurrence of an added instance
beside a trusted pattern of its kind is a span.

DataFrame functions only. Matches and counts per pattern and instance are shuffled, never texts.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import col, stored

KINDS = ("email", "ip", "card", "phone")
# The base patterns, written so that Java's matcher never starts twice within one run of
# characters and never recurses: the matches are those of the plain forms.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What may be an identifier, from seven characters on: a number, of several groups or not, or
# something with an at sign.
CANDIDATE = (r"[0-9(+](?:[() ./-]*+[0-9])++"
             r"|(?<![^ \n\t<(,;:])[^ \n\t<(,;:@]++@[^ \n\t@]{2,}+")
SHORTEST = 7
# Dates and runs of years, which are no identifiers whatever stands beside them.
CONTRARY = (r"^(?:(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2}(?![0-9]).*"
            r"|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}"
            r"|(?:19|20)[0-9]{2}(?:[ /-]+(?:19|20)[0-9]{2})+)$")
# Characters looked at on each side: of a longer word, those nearest to the match.
REACH = 24
# Rounds at most; confidence that a pattern or an instance needs; labelled instances that a pattern
# needs, and their least share among those that aren't contrary.
ROUNDS, CONFIDENCE, SUPPORT, SHARE = 5, 0.7, 5, 0.05
# Spans replaced together: the work on a text of n spans grows with n times this, plus n / this
# times the text.
TOGETHER = 512
SPANS = "array<struct<kind:string,start:int,end:int>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    def part(i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when((n - i) % 2 == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + part(i))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        def small(part):
            bare = F.regexp_replace(part, "^0+", "")
            return (F.length(bare) <= 3) & (F.coalesce(F.substring(bare, 1, 3).try_cast("int"),
                                                       F.lit(0)) <= 255)
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        return _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _word(context: Column, mark: str, pattern: str) -> Column:
    shape = F.regexp_replace(F.lower(F.regexp_extract(context, pattern, 1)), "[0-9]", "0")
    return F.concat(F.lit(mark), shape)


def _hits(kind: str, valid) -> Column:
    """From the gaps between the matches of a text and the matches: array of kind, i, skip (length
    of the gap before), n (length), ok, value, patterns (the word before and the word after)."""
    reach = F.lit(REACH)
    gap = lambda i: F.get("_gaps", i)
    hit = lambda i: F.coalesce(F.get("_hits", i), F.lit(""))

    def one(value, i):
        before = F.right(F.concat(F.right(hit(i - 1), reach), F.right(gap(i), reach)), reach)
        after = F.left(F.concat(F.left(gap(i + 1), reach), F.left(hit(i + 1), reach)), reach)
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(gap(i)).alias("skip"),
            F.length(value).alias("n"), valid(value).alias("ok"), F.lower(value).alias("value"),
            F.array(_word(before, "<", r"(\S*)\s*$"), _word(after, ">", r"^\s*(\S*)"))
            .alias("patterns"))

    return F.transform("_hits", one)


def _scan(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """row, doc_id, text_hash, hits: all matches of all patterns. Without texts, so it is small."""
    body = F.coalesce(col(text).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       col(doc_id).cast("long").alias("doc_id"), body.alias("text"),
                       F.xxhash64(body).alias("text_hash"))
    has = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+")}
    none = F.expr("CAST(array() AS array<string>)")
    sought = [(k, PATTERNS[k], lambda v, k=k: _valid(k, v)) for k in KINDS]
    sought.append(("other", CANDIDATE, lambda v: F.length(v) >= SHORTEST))
    for kind, pattern, valid in sought:
        gaps = F.split("text", pattern, -1)
        hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        if kind in has:
            gaps, hits = F.when(has[kind], gaps), F.when(has[kind], hits).otherwise(none)
        rows = rows.withColumns({"_gaps": gaps, "_hits": hits}).withColumn(
            f"_{kind}", _hits(kind, valid)).drop("_gaps", "_hits")
    return rows.select("row", "doc_id", "text_hash",
                       F.concat(*[f"_{kind}" for kind, _, _ in sought]).alias("hits"))


def _placed(scan: DataFrame) -> DataFrame:
    """row, kind (null: an unlabelled or contrary instance), start, end, value, patterns: one row
    per base span, and per candidate that touches none. One shuffle, of matches, by row."""
    whole = (Window.unboundedPreceding, Window.currentRow)
    in_order = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(*whole)
    hits = (scan.select("row", F.explode("hits").alias("h")).select("row", "h.*")
            .repartition("row")
            .withColumn("end", F.sum(F.col("skip") + F.col("n")).over(in_order).cast("int"))
            .filter("ok").withColumn("start", F.col("end") - F.col("n")))
    base = F.col("kind") != "other"
    forth = Window.partitionBy("row").orderBy("start").rangeBetween(*whole)
    back = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(*whole)
    touches = (F.col("last_end") > F.col("start")) | (F.col("next_start") < F.col("end"))
    return (hits.withColumn("last_end", F.max(F.when(base, F.col("end"))).over(forth))
            .withColumn("next_start", F.min(F.when(base, F.col("start"))).over(back))
            .filter(base | ~F.coalesce(touches, F.lit(False)))
            .select("row", F.when(base, F.col("kind")).alias("kind"), "start", "end", "value",
                    "patterns"))


def _nodes(spans: DataFrame) -> DataFrame:
    """instance, s_<kind> (1 for seeds), none (contrary), can_<kind> (forms it may have)."""
    seen = spans.groupBy(F.col("value").alias("instance")).agg(*[
        F.max((F.coalesce("kind", F.lit("")) == k).cast("double")).alias(f"s_{k}") for k in KINDS])
    digits, at = F.length(_digits(F.col("instance"))), F.col("instance").contains("@")
    checked = F.when(digits.between(13, 19), _luhn(_digits(F.col("instance")))).otherwise(False)
    can = {"email": at, "phone": ~at & digits.between(7, 15), "card": ~at & checked,
           "ip": F.col("instance").rlike(r"^[0-9]{1,3}(?:[^0-9@]{1,3}[0-9]{1,3}){3}$")}
    seed = reduce(or_, [F.col(f"s_{k}") > 0 for k in KINDS])
    contrary = F.col("instance").rlike(CONTRARY) | (~at & digits.between(16, 19) & ~checked)
    return seen.select("instance", *[f"s_{k}" for k in KINDS],
                       (~seed & contrary).alias("none"), *[can[k].alias(f"can_{k}") for k in KINDS])


def _patterns(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """pattern, m_<kind> (labelled instances, by their scores), known (these and the contrary ones,
    and one for doubt), trusted (its kind, or null); patterns without any known instance are left
    out."""
    sums = edges.join(nodes, "instance").groupBy("pattern").agg(
        F.count(F.lit(1)).alias("total"), F.sum(F.col("none").cast("double")).alias("contrary"),
        *[F.sum(f"s_{k}").alias(f"m_{k}") for k in KINDS],
        *[F.sum((F.col(f"s_{k}") > 0).cast("int")).alias(f"n_{k}") for k in KINDS])
    known = reduce(add, [F.col(f"m_{k}") for k in KINDS]) + F.col("contrary") + 1
    fits = [F.when((F.col(f"m_{k}") >= CONFIDENCE * F.col("known")) & (F.col(f"n_{k}") >= SUPPORT)
                   & (F.col(f"n_{k}") >= SHARE * (F.col("total") - F.col("contrary"))), k)
            for k in KINDS]  # more than half of what is known: one kind at most
    return sums.withColumn("known", known).filter("known > 1").select(
        "pattern", "known", *[f"m_{k}" for k in KINDS], F.coalesce(*fits).alias("trusted"))


def _promoted(edges: DataFrame, nodes: DataFrame, patterns: DataFrame) -> DataFrame:
    """instance, kind, score of the unlabelled instances that are confident now."""
    open_ = nodes.filter(~reduce(or_, [F.col(f"s_{k}") > 0 for k in KINDS]) & ~F.col("none")
                         & reduce(or_, [F.col(f"can_{k}") for k in KINDS]))
    scores = (edges.join(open_.select("instance", *[f"can_{k}" for k in KINDS]), "instance")
              .join(patterns, "pattern").groupBy("instance").agg(
                  *[F.first(f"can_{k}").alias(f"can_{k}") for k in KINDS],
                  *[(F.sum(f"m_{k}") / F.sum("known")).alias(f"p_{k}") for k in KINDS],
                  *[F.max(F.coalesce(F.col("trusted") == k, F.lit(False))).alias(f"t_{k}")
                    for k in KINDS]))
    fits = [F.when(F.col(f"can_{k}") & F.col(f"t_{k}") & (F.col(f"p_{k}") >= CONFIDENCE),
                   F.struct(F.lit(k).alias("kind"), F.col(f"p_{k}").alias("score")))
            for k in KINDS]
    return scores.select("instance", F.coalesce(*fits).alias("b")).filter("b IS NOT NULL").select(
        "instance", "b.kind", "b.score")


def _scored(spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pattern, kind) of the trusted patterns and (value, kind) of the instances added."""
    edges = stored(spans.select(F.col("value").alias("instance"),
                                F.explode("patterns").alias("pattern"))
                   .filter(F.length("pattern") > 1).distinct(), "edges")
    nodes = stored(_nodes(spans), "instances")
    patterns, added = None, []
    for _ in range(ROUNDS):
        patterns = stored(_patterns(edges, nodes), "patterns")
        new = stored(_promoted(edges, nodes, patterns), "promoted")
        if new.isEmpty():
            break
        added.append(new)
        nodes = stored(nodes.join(new, "instance", "left").select(
            "instance", "none", *[f"can_{k}" for k in KINDS],
            *[F.when(F.col("kind") == k, F.col("score")).otherwise(F.col(f"s_{k}")).alias(f"s_{k}")
              for k in KINDS]), "instances")
    names = added or [new]
    return (patterns.filter("trusted IS NOT NULL").select("pattern", F.col("trusted").alias("kind")),
            reduce(DataFrame.unionByName, names).select(F.col("instance").alias("value"), "kind"))


def _spans(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """row, doc_id, text_hash of every row; row, kind, start, end, added of every span."""
    scan = stored(_scan(docs, doc_id, text), "scan")
    spans = stored(_placed(scan), "spans")
    trusted, added = _scored(spans)
    new = (spans.filter("kind IS NULL").drop("kind").join(added, "value")
           .select("row", "start", "end", "kind", F.explode("patterns").alias("pattern"))
           .join(trusted, ["pattern", "kind"]).select("row", "kind", "start", "end").distinct())
    both = spans.filter("kind IS NOT NULL").select(
        "row", "kind", "start", "end", F.lit(False).alias("added")).unionByName(
        new.withColumn("added", F.lit(True)))
    return scan.select("row", "doc_id", "text_hash"), both


def _joined(spans: Column) -> Column:
    """kind:start:end by kind as listed, then start, joined by commas."""
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(
        order[s["kind"]].alias("k"), s["start"].alias("start"), s["end"].alias("end"),
        s["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base and added (arrays of kind, start, end), n_email,
    n_ip, n_card, n_phone, base_sha256, spans.

    Counts and base_sha256 are of the base spans alone; spans has all. Positions are code points,
    the end exclusive. Null is the empty text, which has no spans; repeated rows are judged one
    by one, but an instance that occurs again counts once in a pattern's score; other columns are
    not looked at; a null id stays null; an empty table gives an empty result. Texts are looked at
    whole, in one pass for each pattern; the work is linear in the text and its matches, but for
    sorting these.
    """
    rows, spans = _spans(docs, doc_id, text)
    span = F.struct("kind", "start", "end")
    arrays = spans.groupBy("row").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("added") == new, span))).alias(name)
        for name, new in (("base", False), ("added", True))])
    none = F.expr(f"CAST(array() AS {SPANS})")
    rows = rows.join(arrays, "row", "left").select(
        "doc_id", F.coalesce("base", none).alias("base"), F.coalesce("added", none).alias("added"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id", "base", "added", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"))


def _islands(spans: DataFrame) -> DataFrame:
    """row, _spans: array of (start, end, kind), spans that overlap made one of the first's kind."""
    order = Window.partitionBy("row").orderBy("start", F.desc("end"), "kind")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (F.col("start") >= F.coalesce("reached", F.lit(0))).cast("long")
    first = F.min(F.struct("start", -F.col("end"), "kind"))
    return (spans.withColumn("reached", reached)
            .withColumn("island", F.sum(fresh).over(
                order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .groupBy("row", "island").agg(first.alias("f"), F.max("end").alias("end"))
            .groupBy("row").agg(F.array_sort(F.collect_list(
                F.struct("f.start", "end", "f.kind"))).alias("_spans")))


def _replaced() -> Column:
    """``_body`` with ``_spans`` replaced, TOGETHER of them at a time on the stretch of text that
    they are in: a place in a long text is found by reading up to it."""
    def stretch(j):
        at = j * TOGETHER
        begin = F.when(j == 0, 0).otherwise(F.get("_spans", at)["start"])
        end = F.coalesce(F.get("_spans", at + TOGETHER)["start"], F.length("_body"))
        return F.struct(begin.alias("begin"), F.slice("_spans", at + 1, TOGETHER).alias("spans"),
                        F.substring("_body", begin + 1, end - begin).alias("part"))

    def clean(z):
        def step(acc, s):
            gap = F.substring(z["part"], acc["at"] + 1, s["start"] - z["begin"] - acc["at"])
            return F.struct((s["end"] - z["begin"]).alias("at"), F.concat(
                acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"))
        return F.aggregate(
            z["spans"], F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
            lambda acc: F.concat(acc["out"], F.substring(z["part"], acc["at"] + 1,
                                                         F.length(z["part"]))))

    last = F.floor((F.size("_spans") - 1) / TOGETHER).cast("int")
    return F.array_join(F.transform(F.transform(F.sequence(F.lit(0), last), stretch), clean), "")


def redacted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             n_chars: str = "n_chars") -> DataFrame:
    """The rows with every span replaced by its kind in brackets, such as ``[EMAIL]``; where
    spans overlap the one that starts first (then the longer) counts and the others are cut off
    with it. n_chars follows the text. A null text stays null, a text without spans as it is. A row
    is found again by id and text, so rows that repeat both get the same text, and rows of a null
    or reused id their own. Other columns are passed on; an empty table stays empty."""
    body = F.coalesce(col(text).cast("string"), F.lit(""))
    rows, spans = _spans(docs, doc_id, text)
    spans = (rows.join(_islands(spans), "row").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_spans").distinct())
    marked = docs.withColumn("_body", body).withColumn("_h", F.xxhash64("_body"))
    joined = marked.join(spans, col(doc_id).cast("long").eqNullSafe(F.col("_id"))
                         & (F.col("_h") == F.col("_hash")), "left")
    joined = joined.withColumn("_new", F.when(
        F.col("_spans").isNull(), col(text).cast("string")).otherwise(_replaced()))
    return joined.select(*[
        F.col("_new").alias(c) if c == text else
        (F.length("_new").cast(docs.schema[c].dataType).alias(c) if c == n_chars else col(c))
        for c in docs.columns])
