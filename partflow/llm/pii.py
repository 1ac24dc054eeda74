"""Personal data by candidate gradient boosting. DataFrame functions and JVM learners only.

* Base rules find e-mail, IP, card and phone spans; they always stay.
* High-recall generators propose further, overlapping candidates of each kind. Each has
  features of its format and of the text around it.
* Boosted trees are trained on the candidates of a bounded sample of documents
  (``TRAIN_DOCS``). Positives are the candidates that overlap a base span of their kind, with
  the format that tells them masked (``mask``: the plus sign dropped, ``@`` spelled out,
  separators changed), so that the trees learn from shape and context what the base rules
  can't see; the features hold no base pattern. All other candidates are unlabelled. The
  trees are written out as one column expression, so scoring is a plain projection: no row
  leaves its place and nothing is joined back.
* The score of a labelled candidate is the probability of being labelled; divided by its mean
  over positives that didn't train the trees it is the probability of the kind (positives
  labelled at random). That mean is taken per kind over all documents outside training.
  Candidates with a probability of ``SURE`` at least that overlap no other span are added.
  On tables that hold no personal data but in the base formats none is.

Long arrays are worked on in chunks, so that the work for a text of very many matches stays
near to linear in them.

Positions are code points, ends exclusive. Null texts count as empty: no spans. Repeated
rows each get their row; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import hash_chosen, hash_sample, store, text_of

KINDS = ("email", "ip", "card", "phone")

#: The base patterns. Possessive loops and the look-behind keep them linear; a
#: match begins at the start of its run, or right behind the match before.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
         r"(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Digits with separators among them, cut at two separators in a row.
DIGITS, CUT = r"[0-9][0-9\x20-]*[0-9]", r"[\x20-]{2,}"
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.(?=.)|$)){4}$"

#: Generators: what could be personal data in another format; strings of which a text with a
#: match holds one, or (where True) else a digit.
WIDE = {
    "email": (r"[^\s@<>,;:()\[\]]{1,64}+\x20?(?:@|\[at\]|\(at\))\x20?"
              r"[^\s@<>,;:()\[\]]{3,190}", ("@", "[at]", "(at)"), False),
    "ip": (r"(?:(?<![0-9A-Fa-f.:])[0-9]{1,3}(?:[.,][0-9]{1,3}){3}(?![0-9.])"
           r"|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:]))",
           (":",), True),
    "card": (r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){11,18}(?![0-9])", (), True),
    "phone": (r"(?<![0-9])\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}(?![0-9])", (), True),
}

#: Most documents whose candidates train the trees, and most candidates.
TRAIN_DOCS, TRAIN_ROWS = 20_000, 40_000
#: Probability from which on a candidate is added.
SURE = 0.9
#: Characters of context on each side.
AROUND = 24
#: Elements of an array that are folded in one piece.
CHUNK = 256

SPAN = "array<struct<start:int,stop:int,s:string,left:string,right:string>>"


DIGIT = "[0-9]"


def find(text: Column, pattern: str, gate: Column) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as an array of (start, stop, s, left,
    right). Positions add up the lengths of matches and of the gaps between them. ``gate`` is
    a cheap condition that every text with a match fulfils; other texts are skipped."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    found = _placed(gaps, matches)
    return F.when(gate, found).otherwise(F.array().cast(SPAN))


def holds(text: Column, *some: str) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in some])


def bound(x: Column, f) -> Column:
    """``f`` of ``x``, which is computed once wherever and how often ``f`` uses it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def chunks(a: Column) -> Column:
    """``a`` in order, cut into arrays of ``CHUNK`` elements; one empty array if it is empty."""
    last = F.floor(F.greatest(F.size(a) - 1, F.lit(0)) / CHUNK).cast("int")
    return bound(a, lambda x: F.transform(
        F.sequence(F.lit(0), last), lambda i: F.slice(x, i * CHUNK + 1, CHUNK)))


def _placed(gaps: Column, matches: Column, of_gaps: bool = False) -> Column:
    """The matches (or the gaps) with their places, from alternating gaps and matches."""
    rows = F.arrays_zip(gaps.alias("g"), matches.alias("m"), _next(gaps).alias("n"))

    def length(x):
        return F.length(x["g"]) + F.coalesce(F.length(x["m"]), F.lit(0))

    def step(acc, x):
        at = acc["at"] + F.length(x["g"])
        end = acc["at"] + length(x)
        empty = F.lit("")
        if of_gaps:
            new = F.struct(acc["at"].alias("start"), at.alias("stop"), x["g"].alias("s"),
                           empty.alias("left"), empty.alias("right"))
            some = F.length(x["g"]) > 0
        else:
            new = F.struct(at.alias("start"), end.alias("stop"), x["m"].alias("s"),
                           F.right(x["g"], F.lit(AROUND)).alias("left"),
                           F.left(F.coalesce(x["n"], empty), F.lit(AROUND)).alias("right"))
            some = x["m"].isNotNull()
        return F.struct(end.alias("at"), F.when(some, F.concat(
            acc["found"], F.array(new).cast(SPAN))).otherwise(acc["found"]).alias("found"))

    def place(cut):
        sums = F.transform(cut, lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + length(x)))
        starts = F.aggregate(sums, F.array(F.lit(0)), lambda n, x: F.concat(
            n, F.array(F.element_at(n, -1) + x)))
        return bound(starts, lambda at: F.flatten(F.transform(cut, lambda c, i: F.aggregate(
            c, F.struct(F.get(at, i).alias("at"), F.array().cast(SPAN).alias("found")), step,
            lambda acc: acc["found"]))))
    return bound(chunks(rows), place)


def _next(a: Column) -> Column:
    return F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))


def only_digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn's check of a string of digits (at most 19 of them matter)."""
    doubled = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 1, F.element_at(doubled, c.try_cast("int") + 1)).otherwise(c.try_cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _between(x: Column, low: int, high: int) -> Column:
    return (x >= low) & (x <= high)


def card_spans(text: Column, digit: Column) -> Column:
    """Digit sequences with single separators, 12 to 19 digits that pass Luhn's check. The
    pattern's loop over separators is replaced by a cut at double ones: no deep recursion."""
    runs = F.filter(find(text, DIGITS, digit), lambda t: F.length(t["s"]) >= 12)
    parts = F.flatten(F.transform(runs, lambda t: F.transform(
        _placed(F.split(t["s"], CUT, -1), F.regexp_extract_all(t["s"], F.lit(CUT), F.lit(0)),
                of_gaps=True),
        lambda p: F.struct((t["start"] + p["start"]).alias("start"),
                           (t["start"] + p["stop"]).alias("stop"), p["s"].alias("s")))))
    sized = F.filter(parts, lambda p: _between(F.length(only_digits(p["s"])), 12, 19))
    return F.filter(sized, lambda p: luhn(only_digits(p["s"])))


def base_spans(text: Column, digit: Column) -> dict[str, Column]:
    """The base rules' spans per kind. ``digit``: whether the text holds a digit."""
    return {
        "email": find(text, EMAIL, holds(text, "@")),
        "ip": F.filter(find(text, IP, digit & holds(text, ".")),
                       lambda x: x["s"].rlike(OCTETS)),
        "card": card_spans(text, digit),
        "phone": F.filter(find(text, PHONE, digit & holds(text, "+")),
                          lambda x: _between(F.length(only_digits(x["s"])), 9, 15)),
    }


#: Words near a candidate that speak for or against its kind (several languages).
HINTS = ("mail|courriel|correo", "tel|phone|call|fax|mobil|tél", "card|visa|kart|carte|tarjeta",
         r"\bip\b|host|server|addr|adress", "token|key|hash|id|order|invoice|version|isbn",
         r"[0-9]")


def features(kind: Column, c: Column) -> list[Column]:
    """Format and context features of a candidate."""
    s, near = c["s"], F.lower(c["left"])
    n = F.length(s)
    digits = F.length(only_digits(s))

    def flag(x):
        return x.cast("double")

    def count(chars):
        return (n - F.length(F.translate(s, chars, ""))).cast("double")

    return [*[flag(kind == k) for k in KINDS], n.cast("double"), digits.cast("double"),
            *[count(x) for x in (".", "-", " ", "()", ":", "/")],
            F.coalesce(F.substring(only_digits(s), 1, 1).try_cast("double"), F.lit(-1.0)),
            flag(F.when(_between(digits, 12, 19), luhn(only_digits(s))).otherwise(False)),
            flag(F.translate(s, ",", ".").rlike(OCTETS)),
            flag(s.rlike(r"\p{L}\.\p{L}{2,}\W*$")),
            flag(c["left"].rlike(r"[\s(\[<\"']$") | (c["left"] == "")),
            flag(c["left"].rlike(r"[0-9A-Za-z]$")), flag(c["right"].rlike(r"^[0-9A-Za-z]")),
            flag(c["right"].rlike(r"^[\s.,;:!?)\]>\"']") | (c["right"] == "")),
            *[flag(near.rlike(h)) for h in HINTS]]


def mask(kind: str, c: Column) -> Column:
    """A labelled candidate without the format that the base rules know it by, in one of a few
    variants, chosen by its hash."""
    s, left = c["s"], c["left"]
    pick = F.pmod(F.xxhash64(s, left), F.lit(3))

    def variant(*some):
        return F.when(pick == 0, some[0]).when(pick == 1, some[1]).otherwise(some[2])
    if kind == "email":
        s = variant(F.replace(s, F.lit("@"), F.lit(" [at] ")),
                    F.replace(s, F.lit("@"), F.lit("(at)")),
                    F.replace(s, F.lit("@"), F.lit(" @ ")))
    elif kind == "ip":
        s = variant(F.translate(s, ".", ","), s, s)
    elif kind == "card":
        d = only_digits(s)
        s = variant(F.regexp_replace(d, r"([0-9]{4})(?=[0-9])", "$1."),
                    F.regexp_replace(d, r"([0-9]{4})(?=[0-9])", "$1/"), d)
    else:
        left = F.regexp_replace(left, r"\+\x20?$", "")
        s = variant(F.ltrim(F.regexp_replace(s, r"^\+?[0-9]\x20?(?=\()", "")),
                    F.translate(s, "+", ""), F.translate(F.translate(s, "+()", ""), " ", "-"))
    return F.struct(s.alias("s"), left.alias("left"), c["right"].alias("right"))


def _same_type(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda c: F.struct(
        F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("nth"),
        c["start"].alias("start"), c["stop"].alias("stop")))


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


def blocks(spans: Column) -> Column:
    """Sorted spans that don't overlap, in chunks that know from where to where they reach."""
    some = F.filter(chunks(spans), lambda c: F.size(c) > 0)
    return F.transform(some, lambda c: F.struct(
        F.element_at(c, 1)["start"].alias("start"), F.element_at(c, -1)["stop"].alias("stop"),
        F.transform(c, lambda x: F.struct(x["start"].alias("start"),
                                          x["stop"].alias("stop"))).alias("spans")))


def _meets(some: Column, c: Column) -> Column:
    """Whether ``c`` overlaps a span of the ``blocks``: those chunks only are looked into that
    reach to it."""
    return F.exists(some, lambda b: _overlaps(b, c) & F.exists(
        b["spans"], lambda x: _overlaps(x, c)))


def candidates(docs: DataFrame, text: str, masked: bool = False) -> DataFrame:
    """``docs`` with ``_base`` (the base spans of all kinds) and ``_wide`` (candidates with
    their kind, features and whether they overlap a base span of their kind; where ``masked``,
    those that do have the features of their masked form)."""
    t, digit = text_of(text), F.col("_digit")
    rows = docs.withColumn("_digit", t.rlike(DIGIT))

    def gate(some, digits):
        return holds(t, *some) | digit if some and digits else digit if digits \
            else holds(t, *some)
    rows = rows.select("*", *[v.alias(f"_base_{k}") for k, v in base_spans(t, digit).items()],
                       *[find(t, p, gate(some, digits)).alias(f"_wide_{k}")
                         for k, (p, some, digits) in WIDE.items()])

    def described(k):
        known = bound(blocks(F.col(f"_base_{k}")), lambda b: F.transform(
            f"_wide_{k}", lambda c: F.struct(
                c["start"].alias("start"), c["stop"].alias("stop"), c["s"].alias("s"),
                c["left"].alias("left"), c["right"].alias("right"),
                _meets(b, c).alias("label"))))
        if masked:
            known = F.transform(known, lambda c: F.when(c["label"], F.struct(
                c["start"].alias("start"), c["stop"].alias("stop"), mask(k, c)["s"].alias("s"),
                mask(k, c)["left"].alias("left"), c["right"].alias("right"),
                c["label"].alias("label"))).otherwise(c))
        return F.transform(known, lambda c: F.struct(
            F.lit(k).alias("kind"), F.lit(KINDS.index(k)).alias("nth"),
            c["start"].alias("start"), c["stop"].alias("stop"), c["label"].alias("label"),
            F.array(*features(F.lit(k), c)).alias("f")))
    return rows.select(*docs.columns,
                       F.concat(*[_same_type(k, F.col(f"_base_{k}"))
                                  for k in KINDS]).alias("_base"),
                       F.concat(*map(described, KINDS)).alias("_wide"))


def _expression(model, f: Column) -> Column:
    """The boosted trees' probability as a column expression over the feature array."""
    line = re.compile(r"(If|Else) \(feature (\d+) (<=|>) (\S+)\)|Predict: (\S+)")

    def tree(lines):
        m = line.search(lines.pop(0))
        if m[5]:
            return F.lit(float(m[5]))
        cond = f[int(m[2])] <= float(m[4])
        yes = tree(lines)
        lines.pop(0)                                   # the Else line
        return F.when(cond, yes).otherwise(tree(lines))

    total = F.lit(0.0)
    for t, w in zip(model.trees, model.treeWeights):
        total = total + float(w) * tree([x for x in t.toDebugString.split("\n")
                                         if line.search(x)])
    return 1 / (1 + F.exp(-2 * total))


def fit(docs: DataFrame, text: str = "text"):
    """(model, least score per kind): the trees from a bounded sample of distinct texts of
    ``docs``, the scores from the masked positives of all documents that did not train them;
    (None, {}) where the sample has candidates of one label only."""
    docs = docs.select(text_of(text).alias("t"))
    drawn = hash_chosen(docs, F.col("t"), TRAIN_DOCS)
    train = F.pmod(F.xxhash64(F.lit("part"), F.xxhash64("t")), F.lit(10)) < 7
    some = store(docs.where(drawn & train).dropDuplicates(["t"]), "pii-texts")
    rows = store(candidates(some, "t", masked=True).select(
        F.xxhash64("t").alias("h"), F.explode("_wide").alias("c")).select("h", "c.*"),
        "pii-candidates")
    rows = store(hash_sample(rows, F.struct("h", "kind", "start"), TRAIN_ROWS)
                 .select(F.col("label").cast("double").alias("label"), "f").coalesce(2),
                 "pii-sample")
    if rows.select("label").distinct().count() < 2:
        return None, {}
    model = GBTClassifier(featuresCol="x", labelCol="label", maxIter=12, maxDepth=4,
                          stepSize=0.3, seed=7).fit(
        rows.select("label", array_to_vector("f").alias("x")))
    held = (candidates(docs.where(~(drawn & train)), "t", masked=True)
            .select(F.explode(F.filter("_wide", lambda c: c["label"])).alias("c"))
            .select(F.col("c.kind").alias("kind"), _expression(model, F.col("c.f")).alias("p")))
    mean = {r["kind"]: r["p"] for r in held.groupBy("kind").agg(F.avg("p").alias("p")).collect()}
    return model, {k: SURE * p for k, p in mean.items()}


def spans(docs: DataFrame, model, limits: dict[str, float], text: str = "text") -> DataFrame:
    """``own`` (the row as a struct, so that no name clashes), ``_base`` and ``_spans``, both
    sorted by start and kind: the base spans, and those with the candidates that the model
    adds."""
    rows = candidates(docs.select(F.struct(*docs.columns).alias("own"),
                                  F.col(text).alias("t")), "t")
    if model is None or not limits:
        rows = rows.withColumn("_added", F.filter("_base", lambda x: F.lit(False)))
    else:
        limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])
        base = F.concat(*[blocks(_of_kind(k, "_base")) for k in KINDS])
        rows = rows.withColumn("_wide", bound(base, lambda b: F.filter(
            "_wide", lambda c: ~_meets(b, c))))
        chosen = F.filter("_wide", lambda c: _expression(model, c["f"])
                          >= F.coalesce(F.element_at(limit, c["kind"]), F.lit(2.0)))
        rows = rows.withColumn("_added", F.transform(F.array_sort(F.transform(
            chosen, lambda c: F.struct(c["start"].alias("start"), c["nth"].alias("nth"),
                                       c["kind"].alias("kind"), c["stop"].alias("stop")))),
            lambda c: F.struct(c["kind"].alias("kind"), c["nth"].alias("nth"),
                               c["start"].alias("start"), c["stop"].alias("stop"))))
        rows = rows.withColumn("_added", _first_of_overlapping(F.col("_added")))
    return rows.select("own", "t", _sorted(F.col("_base")).alias("_base"),
                       _sorted(F.concat("_base", "_added")).alias("_spans"))


def _first_of_overlapping(a: Column) -> Column:
    """Of spans sorted by start, those that don't overlap one that stays before them."""
    none = F.array().cast("array<struct<kind:string,nth:int,start:int,stop:int>>")

    def step(acc, c):
        return F.when(c["start"] < acc["stop"], acc).otherwise(F.struct(
            c["stop"].alias("stop"), F.concat(acc["found"], F.array(c)).alias("found")))

    def chunk(acc, some):
        first = F.struct(acc["stop"].alias("stop"), none.alias("found"))
        return bound(F.aggregate(some, first, step), lambda x: F.struct(
            x["stop"].alias("stop"), F.concat(acc["found"], x["found"]).alias("found")))
    return F.aggregate(chunks(a), F.struct(F.lit(0).alias("stop"), none.alias("found")), chunk,
                       lambda acc: acc["found"])


def _sorted(a: Column) -> Column:
    return F.sort_array(F.transform(a, lambda c: F.struct(
        c["start"].alias("start"), c["nth"].alias("nth"), c["stop"].alias("stop"),
        c["kind"].alias("kind"))))


def _of_kind(kind: str, spans: str = "_spans") -> Column:
    return F.filter(spans, lambda c: c["kind"] == kind)


def written(a: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(a, lambda c: F.concat_ws(
        ":", c["kind"], c["start"].cast("string"), c["stop"].cast("string"))))


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the number of spans per kind, the digest of the base spans and all spans
    in place of the text (and of columns that bear one of these names)."""
    new = {f"n_{k}": F.size(_of_kind(k)).cast("long") for k in KINDS}
    new["base_sha256"] = F.sha2(written(F.col("_base")).cast("binary"), 256)
    new["spans"] = written(F.col("_spans"))
    rows = spans(docs, *fit(docs, text), text)
    return rows.select(*[F.col("own")[c].alias(c) for c in docs.columns
                         if c != text and c not in new], *[v.alias(k) for k, v in new.items()])


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; of spans that overlap, the
    first one's name stands for all. Null texts stay null."""
    rows = spans(docs, *fit(docs, text), text)
    t = F.col("t")

    def step(part, base):
        return lambda a, c: F.when(c["start"] < a["at"], F.struct(
            F.greatest(a["at"], c["stop"]).alias("at"), a["out"].alias("out"))).otherwise(
            F.struct(c["stop"].alias("at"), F.concat(
                a["out"], F.substring(part, a["at"] - base + 1, c["start"] - a["at"]),
                F.lit("["), F.upper(c["kind"]), F.lit("]")).alias("out")))

    def chunk(acc, some):
        # Spans of a chunk are cut out of the chunk's part of the text.
        end = F.greatest(F.array_max(F.transform(some, lambda c: c["stop"])), acc["at"])
        part = F.substring(t, acc["at"] + 1, end - acc["at"])
        first = F.struct(acc["at"].alias("at"), F.lit("").alias("out"))
        return bound(bound(part, lambda p: F.aggregate(some, first, step(p, acc["at"]))),
                     lambda x: F.struct(x["at"].alias("at"), F.concat(
                         acc["out"], F.array(x["out"])).alias("out")))
    cut = F.aggregate(
        chunks(F.col("_spans")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), chunk,
        lambda a: F.concat(F.array_join(a["out"], ""),
                           F.substring(t, a["at"] + 1, F.length(t))))
    return rows.select(*[F.when(F.size("_spans") > 0, cut).otherwise(t).alias(c)
                         if c == text else F.col("own")[c].alias(c) for c in docs.columns])
