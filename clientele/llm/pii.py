"""Personal data by candidate gradient boosting, with DataFrame and SQL functions only.

Exact detectors (email, ip, card, phone) give the base spans, which always stay.  High-recall generators propose
further, overlapping spans: written-out addresses, quads with spaces, numbers in phone shape without a plus
sign, long runs that look like secrets.  Boosted trees judge every candidate by format and context (lengths,
groups, separators, variety of characters, neighbours, cue words); they do not see which generator it came from.
Their labels are the detectors' verdicts and, for proposals, a strict reading of value and context: a valid
address or quad when written plainly, ten digits with an area code in brackets or a cue, a key-like value
after a cue.  A third of the rows calibrates a threshold for each kind: the lowest score from which the share of
true labels is PRECISION (all kinds' threshold where a kind has none there).  Candidates above it that touch no base
span are added, of a chain of overlapping ones the best.  With labels of one outcome only no trees are
fitted and the true ones among them are added.

The trees are fitted on at most SAMPLE candidates (a hash picks them); everything else covers all rows.
Spans are code-point offsets, end exclusive.

Work and memory grow in step with a text's length and number of matches: offsets are sums over blocks of BLOCK
matches, a match's context is cut from the stretches on its sides, overlaps are running maxima over sorted
spans (a window over one text's candidates), and redaction cuts from pieces of PIECE characters.

Edge cases: null is the empty text; texts without candidates have no spans; texts of any length are read whole
(patterns are possessive and start only where a run does, so long runs cost linear time); repeated rows give
the same spans; an empty table gives no rows; other columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import row_key
from clientele.session import freeze

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
SAMPLE = 40_000
PRECISION = 0.98
BLOCK = 1024
PIECE = 1000

_LOCAL = r"[A-Za-z0-9._%+-]"
_BASE = {
    # \G or the look-behind: a match begins where a run of local characters does, or right behind the last match
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # runs of fewer than 13 digits fail anyway
    "card": r"[0-9](?:[ -]?[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_MORE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3} ?\. ?[0-9]{1,3} ?\. ?[0-9]{1,3} ?\. ?[0-9]{1,3}(?![0-9.])",
    "phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    # looked for where the text has a digit: a value without any is not key-like
    "secret": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}+",
}
_CUES = r"(?i)call|tel|phone|fax|mail|contact|card|visa|pay|account|host|server|addr"
_SECRET_CUES = r"""(?i)(?:token|key|secret|passw(?:or)?d|pwd|auth|bearer|credential)[\s"':=>-]*$"""
_SPAN = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def _matched(text: Column, pattern: str, possible: Column) -> tuple[Column, Column]:
    """All leftmost non-overlapping matches, and the pieces between them (NULL where none is possible)."""
    return F.when(possible, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), F.when(possible, F.split(text, pattern, -1))


def _placed(hits: Column, gaps: Column) -> Column:
    """Matches with their places and the text on their sides (as far as the next match).

    The pieces between the matches give the offsets.  Growing one array match by match would copy it each time, so
    every block of BLOCK matches sums up what stands before it and grows an array of its own."""
    n = F.size(hits)
    both = F.zip_with(hits, F.slice(gaps, F.lit(1), n), lambda m, p: F.struct(
        m.alias("m"), F.length(p).alias("gap"), (F.length(p) + F.length(m)).alias("step"), F.right(p, F.lit(30)).alias("before")))
    both = F.zip_with(both, F.slice(gaps, F.lit(2), n), lambda x, p: F.struct(
        x["m"].alias("m"), x["gap"].alias("gap"), x["step"].alias("step"), x["before"].alias("before"), F.substring(p, 1, 15).alias("after")))

    def step(acc: Column, x: Column) -> Column:
        lo = acc["at"] + x["gap"]
        hi = acc["at"] + x["step"]
        span = F.struct(lo.alias("start"), hi.alias("end"), x["m"].alias("value"), x["before"].alias("before"), x["after"].alias("after"))
        return F.struct(hi.alias("at"), F.array_append(acc["spans"], span).alias("spans"))

    def block(all_: Column):
        def spans(b: Column) -> Column:
            before = F.aggregate(F.slice(all_, F.lit(1), b * BLOCK), F.lit(0), lambda total, x: total + x["step"])
            start = F.struct(before.alias("at"), F.array().cast(_SPAN).alias("spans"))
            return F.aggregate(F.slice(all_, b * BLOCK + 1, F.lit(BLOCK)), start, step, lambda acc: acc["spans"])
        return F.flatten(F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")), spans))

    none = F.array().cast(_SPAN)
    found = F.transform(F.array(both), block)[0]  # names the zipped pieces once
    return F.when(F.coalesce(n, F.lit(0)) > 0, found).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = _digits(value)
    size = F.length(digits)

    def weigh(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((size - i) % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), size), weigh), F.lit(0), lambda s, x: s + x)
    return size.between(13, 19) & (total % 10 == 0)


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    part = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) < 3) | ((F.length(part(p)) == 3) & (F.substring(part(p), 1, 3) <= "255")))


def _side(char: Column) -> Column:
    """Class of a neighbouring character."""
    return (F.when(char == "", 6).when(char == " ", 0).when(char == "\n", 1).when(char.rlike("[A-Za-z]"), 2).when(char.rlike("[0-9]"), 3)
            .when(char.rlike("[\"'=:]"), 4).otherwise(5).cast("double"))


#: Format and context features of a candidate.
FEATURES = ("kind", "size", "digits", "letters", "groups", "separators", "kinds_of_separator", "variety", "hexadecimal", "bracket", "first",
            "before_side", "after_side", "cue", "secret_cue", "near_digits")


def _features(kind: int, span: Column) -> list[Column]:
    value, before, after = span["value"], span["before"], span["after"]
    marks = F.regexp_replace(value, "[A-Za-z0-9]", "")
    size = lambda c: F.length(c).cast("double")
    number = [F.lit(float(kind)), size(value), size(_digits(value)), size(F.regexp_replace(value, "[^A-Za-z]", "")),
              F.size(F.split(value, "[^A-Za-z0-9]+")).cast("double"), size(marks),
              F.size(F.array_distinct(F.split(marks, ""))).cast("double"), F.size(F.array_distinct(F.split(F.substring(value, 1, 200), ""))).cast("double"),
              value.rlike("^[0-9a-fA-F]++$").cast("double"), F.contains(value, F.lit("(")).cast("double"),
              F.coalesce(F.substring(_digits(value), 1, 1).try_cast("double"), F.lit(-1.0)), _side(F.right(before, F.lit(1))), _side(F.substring(after, 1, 1)),
              before.rlike(_CUES).cast("double"), before.rlike(_SECRET_CUES).cast("double"), size(_digits(F.concat(before, after)))]
    return [c.alias(n) for c, n in zip(number, FEATURES)]


def _plain(kind: str, span: Column) -> Column:
    """The strict reading of a proposal: is its value valid and its context right?"""
    value, before = span["value"], span["before"]
    digits, letters = F.length(_digits(value)), F.length(F.regexp_replace(value, "[^A-Za-z]", ""))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return _valid("ip", F.replace(value, F.lit(" ")))
    if kind == "phone":
        return (digits == 10) & (F.contains(value, F.lit("(")) | before.rlike(_CUES))
    keylike = value.rlike("^[0-9a-fA-F]{32,}+$") | ((digits >= 3) & (letters >= 3) & (F.size(F.array_distinct(F.split(F.substring(value, 1, 200), ""))) >= 10))
    return keylike & before.rlike(_SECRET_CUES)


def detect(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``base`` (for each kind its valid spans) and ``candidates`` (base and proposed spans with label and features)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.withColumn("_text", text)
    text = F.col("_text")
    # what every match of a pattern holds
    quads, numbers = text.rlike("[0-9] ?\\. ?[0-9]"), text.rlike("[0-9][ -]?[0-9]")
    possible = {"email": F.contains(text, F.lit("@")), "ip": quads, "card": numbers, "phone": F.contains(text, F.lit("+"))}
    written = F.contains(text, F.lit("(at)")) | F.contains(text, F.lit("[at]"))
    proposed = {"email": written, "ip": quads, "phone": numbers, "secret": text.rlike("[0-9]") & text.rlike("[A-Za-z0-9_+/=-]{20}")}
    patterns = {f"m{k}": (_BASE[k], possible[k]) for k in KINDS} | {f"p{k}": (p, proposed[k]) for k, p in _MORE.items()}
    # columns of their own, so that each text is matched once: what is built on them reads them several times
    found = {name: _matched(text, *how) for name, how in patterns.items()}
    docs = docs.withColumns({f"_h{name}": hits for name, (hits, _) in found.items()} | {f"_g{name}": gaps for name, (_, gaps) in found.items()})
    docs = docs.withColumns({f"_{name}": _placed(F.col(f"_h{name}"), F.col(f"_g{name}")) for name in patterns})

    def passes(kind: str):
        return lambda s: _valid(kind, s["value"])

    def described(n: int, proposal: bool):
        def row(s: Column) -> Column:
            base = F.lit(False) if proposal else _valid(KINDS[n], s["value"])
            label = _plain(ALL_KINDS[n], s) if proposal else base
            return F.struct(s["start"].alias("start"), s["end"].alias("end"), base.alias("base"), label.alias("label"), *_features(n, s))
        return row

    docs = docs.withColumns({f"_b{k}": F.filter(f"_m{k}", passes(k)) for k in KINDS})
    parts = [F.transform(f"_m{k}", described(n, False)) for n, k in enumerate(KINDS)]
    parts += [F.transform(f"_p{k}", described(n, True)) for n, k in enumerate(ALL_KINDS) if k in _MORE]
    bare = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
    base = F.struct(*[F.transform(f"_b{k}", bare).alias(k) for k in KINDS])
    return docs.withColumn("base", base).withColumn("candidates", F.concat(*parts)).drop(
        "_text", *[f"_{p}{k}" for p in ("m", "p", "b", "hm", "hp", "gm", "gp") for k in ALL_KINDS])


def learn(candidates: DataFrame, sample: int = SAMPLE):
    """Boosted trees and a threshold for each kind, or None where all labels are alike."""
    sizes = {r[0]: r[1] for r in candidates.groupBy("label").count().collect()}
    if min(sizes.get(True, 0), sizes.get(False, 0)) == 0:
        return None
    share = int(min(1.0, sample / sum(sizes.values())) * 1_000_000)
    third = F.pmod(F.xxhash64("_row", F.lit(3)), F.lit(3))
    picked = candidates.filter((third != 0) & (F.pmod(F.xxhash64("_row", "start", F.lit(4)), F.lit(1_000_000)) < share))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(picked.withColumn("y", F.col("label").cast("double"))).select("x", "y")
    if rows.select(F.countDistinct("y")).first()[0] < 2:
        return None
    model = GBTClassifier(featuresCol="x", labelCol="y", maxIter=10, maxDepth=4, seed=17).fit(rows)
    bins = (_judged(candidates.filter(third == 0), model).groupBy("kind", F.floor(F.col("p") * 200).cast("int").alias("bin"))
            .agg(F.count("*").alias("n"), F.sum(F.col("label").cast("int")).alias("good")).collect())

    def limit(mine: list) -> float | None:
        """The lowest score from which PRECISION of the candidates (one more counted good) are good."""
        total = good = 0
        out = None
        for at in sorted({r["bin"] for r in mine}, reverse=True):
            total += sum(r["n"] for r in mine if r["bin"] == at)
            good += sum(r["good"] for r in mine if r["bin"] == at)
            if good and good + 1 >= PRECISION * (total + 1):
                out = at / 200
        return out

    whole = limit(bins)
    limits = {}
    for kind in range(len(ALL_KINDS)):
        mine = [r for r in bins if r["kind"] == kind]
        limits[kind] = limit(mine) if any(r["good"] for r in mine) else whole
    return model, {k: v for k, v in limits.items() if v is not None}


def _judged(candidates: DataFrame, model) -> DataFrame:
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(candidates)
    return model.transform(rows).withColumn("p", vector_to_array("probability")[1]).drop("x", "rawPrediction", "probability", "prediction")


def added(found: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``_row`` and ``added`` (kind number, start, end) of rows in which the trees find more spans."""
    rows = found.filter(F.size("candidates") > 0).select("_row", F.explode("candidates").alias("c")).select("_row", "c.*")
    rows = freeze(rows.dropDuplicates(["_row", "kind", "start", "end", "base"]))  # repeated rows are judged once
    # does it touch a base span? the greatest end of base spans that start before its own end
    key = F.when(F.col("base"), F.col("start")).otherwise(F.col("end"))
    sorted_ = Window.partitionBy("_row").orderBy(key, "base").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(sorted_)
    free = rows.withColumn("_reach", reach).filter(~F.col("base") & (F.coalesce("_reach", F.lit(-1)) <= F.col("start"))).drop("_reach")
    fitted = learn(rows, sample)
    if fitted is None:
        more = free.filter("label").withColumn("p", F.lit(1.0))
    else:
        model, limits = fitted
        limit = F.create_map(*[F.lit(x) for k, v in limits.items() for x in (float(k), float(v))]) if limits else None
        more = _judged(free, model).filter(F.col("p") >= F.try_element_at(limit, F.col("kind")) if limits else F.lit(False))
    by_start = Window.partitionBy("_row").orderBy("start", "end", "kind")
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    chain = F.sum(F.when(F.col("_before") > F.col("start"), 0).otherwise(1)).over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    best = Window.partitionBy("_row", "_chain").orderBy(F.desc("p"), "start", F.desc("end"), "kind")
    more = (more.withColumn("_before", before).withColumn("_chain", chain).withColumn("_place", F.row_number().over(best)).filter("_place = 1"))
    return more.groupBy("_row").agg(F.collect_list(F.struct(F.col("kind").cast("int").alias("kind"), "start", "end")).alias("added"))


def find(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = (), sample: int = SAMPLE, row_col: str = "_row") -> DataFrame:
    """The columns in ``keep``, the row's key, ``base`` and ``spans``: for each kind its sorted spans, base ones and added ones."""
    names = [n for n in keep if n not in ("base", "spans")]
    # spans depend on the text alone; one more column spreads equal texts (a hash of many columns would
    # multiply the constraints that the optimizer infers for renamed ones)
    key = row_key(docs, *names[:1], text_col)
    carried = F.struct(F.lit(0), *[F.col(f"`{n}`") for n in names])  # one column, so that no name clashes
    found = detect(docs.select(carried.alias("_doc"), key.alias("_row"), F.col(text_col).alias("_body")), "_body")
    found = freeze(found.drop("_body"))
    rows = found.join(added(found, sample), "_row", "left")
    extra = lambda n: F.transform(F.filter(F.coalesce("added", F.array()), lambda s: s["kind"] == n),
                                  lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    spans = F.struct(*[F.array_sort(F.concat(F.col(f"base.{k}"), extra(n)) if k in KINDS else extra(n)).alias(k) for n, k in enumerate(ALL_KINDS)])
    return rows.select(*[F.col(f"_doc.`{n}`") for n in names], F.col("_row").alias(row_col), "base", spans.alias("spans"))


def listed(col: str, kinds: tuple[str, ...] = KINDS) -> Column:
    """Spans as text, kind:start:end, by kind as listed and then by start."""
    def shown(kind: str):
        return lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"])

    parts = [F.transform(F.col(f"{col}.{k}"), shown(k)) for k in kinds]
    return F.array_join(F.concat(*parts), ",")


def report(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest of each text's base spans, and all its spans."""
    rows = find(docs, keep=(id_col,))
    counts = [F.size(F.col(f"base.{k}")).cast("long").alias(f"n_{k}") for k in KINDS]
    whole = sum((F.size(F.col(f"spans.{k}")) for k in ALL_KINDS), F.lit(0)).cast("long")
    return rows.select(id_col, *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans", ALL_KINDS).alias("spans"),
                       whole.alias("n_spans"), F.size(F.col("spans.secret")).cast("long").alias("n_secret"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with every span of the text replaced by its kind in angle brackets (overlapping spans by the first's kind)."""
    names = docs.columns
    rest = [n for n in names if n != text_col]
    carried = F.struct(*[F.col(f"`{n}`") for n in names])
    rows = docs.select(row_key(docs, *rest[:1], text_col).alias("_row"), F.col(text_col).alias("_text"), carried.alias("_doc"))
    plain = docs.select(*[F.col(f"`{n}`").alias("first") for n in rest[:1]], F.col(text_col).alias("text"))
    found = find(plain, "text", keep=("first",) if rest else ())

    def marked(kind: str):
        return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"))

    spans = F.concat(*[F.transform(F.col(f"spans.{k}"), marked(k)) for k in ALL_KINDS])
    found = freeze(found.select("_row", spans.alias("_spans"))).filter(F.size("_spans") > 0).dropDuplicates(["_row"])
    # overlapping spans become one region with the first one's kind
    each = found.select("_row", F.explode("_spans").alias("s")).select("_row", "s.*")
    by_start = Window.partitionBy("_row").orderBy("start", "end", "kind")
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    region = F.sum(F.when(F.col("_before") > F.col("start"), 0).otherwise(1)).over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    regions = (each.withColumn("_before", before).withColumn("_region", region).groupBy("_row", "_region")
               .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "end", "kind")).alias("kind"))
               .groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("_regions")))
    rows = rows.join(regions, "_row", "left")
    pieces = F.transform(F.array(F.regexp_extract_all(F.col("_text"), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))), lambda p: _without(p, F.length("_text")))[0]
    clean = F.when(F.col("_regions").isNotNull(), pieces).otherwise(F.col("_text"))
    return rows.select(*[clean.alias(n) if n == text_col else F.col(f"_doc.`{n}`") for n in names])


def _without(pieces: Column, size: Column) -> Column:
    """The text in ``pieces`` of PIECE characters with its ``_regions`` replaced by their kinds."""
    def cut(lo: Column, hi: Column) -> Column:
        first = F.floor(lo / PIECE).cast("int")
        count = F.floor((hi - 1) / PIECE).cast("int") - first + 1
        stretch = F.array_join(F.slice(pieces, first + 1, F.greatest(F.lit(1), count)), "")
        return F.when(hi > lo, F.substring(stretch, lo - first * PIECE + 1, hi - lo)).otherwise(F.lit(""))

    regions = F.col("_regions")
    ends = F.concat(F.array(F.lit(0)), F.transform(regions, lambda r: r["end"]))
    parts = F.zip_with(F.slice(ends, F.lit(1), F.size(regions)), regions, lambda at, r: F.concat(
        cut(at, r["start"]), F.lit("<"), F.upper(r["kind"]), F.lit(">")))
    return F.concat(F.array_join(parts, ""), cut(F.element_at(ends, -1), size))
