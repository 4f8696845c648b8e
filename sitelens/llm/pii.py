"""Personal data by fixed patterns and bootstrapped contextual extraction (native).

Base entities (email, ip, card, phone) are regular-expression matches that pass
their checks.  They and long hexadecimal secrets are the seeds of the bootstrap:

1.  Every span of a seed is an occurrence; its lexical pattern is the two words
    before the span's own start (lower-cased, without symbols glued to the start).
2.  Patterns with at least ``MIN_SUPPORT`` known instances are found in all
    texts, and the distinct plain words after each are counted by hash, at first those of one
    hash range.  Where these alone keep a pattern below ``TRUST``, no text is cut for it in this
    round: a bound, so no result is lost.  For the others, what follows is an instance, whatever it is: a run of tokens with digits, or a single token.
3.  Distinct (pattern, instance) pairs form a graph.  A pattern's
    confidence is the mean score of its instances (with two unknown ones
    added), and an instance's score the noisy-or of its trusted patterns; seeds stay at 1.
4.  Instances that reach ``accept`` and are no seeds are new identifiers, spans of kind
    ``ctx`` (secrets: ``secret``).  Those with a digit or @ and ``WIDE`` characters are looked up in all texts,
    and their patterns join the graph; shorter ones and plain words, which mean
    something else elsewhere, are spans after trusted patterns only.

Steps 2 to 4 are repeated until no pattern and no identifier is new.

Offsets come from splitting the text at the pattern: pieces and matches
alternate, so their lengths add up to positions (code points).  Everything is
DataFrame functions; texts are stored once and joined by what is looked up in them.  A join that
moves texts moves those of rows with something to look up or to mark, told by a bitmap of fixed size.

Defined cases: NULL text is empty and has no spans; two words of over ``NEAR`` characters together are no pattern; a match that fails its
check is dropped without a retry; a ``ctx`` or ``secret`` span that touches a base span is
dropped; repeated rows are judged each; columns of ``keep`` that clash with an
output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of

# Fixed patterns of the base entities.  Lookarounds and possessive quantifiers only save
# backtracking; the matches are the leftmost non-overlapping ones of the plain forms.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
IP_PARTS = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?(?:\.|$)){4}$"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
SECRET = r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,64}+(?![A-Za-z0-9])"
LEAD = r"^[^\p{L}0-9+@\s]*+"
RUN = r"^(?:[^\s0-9]*+[0-9]\S*+(?:(?<=[\p{L}0-9)])[ \t]++[^\s0-9]*+[0-9]\S*+)*+|\S++)"
BASE_KINDS = ("email", "ip", "card", "phone")

ACCEPT = 0.8
TRUST = 0.5
MIN_SUPPORT = 3
#: Hash ranges of words; those of one are counted first.
RANGES = 64
#: A pass over the graph that raises no score by more is the last one.
STEADY = 0.01
WIDE = 6
NEAR = 1_000
#: Bits of the bitmap of rows that a join needs.
SLOTS = 1 << 22


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, m>> of all matches."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.lit(None).cast("array<struct<start:int,end:int,m:string>>")
    pairs = F.arrays_zip(pieces.alias("p"), found.alias("m"))
    first = F.struct(F.lit(0).alias("at"), F.array_compact(F.coalesce(empty, F.array().cast("array<struct<start:int,end:int,m:string>>"))).alias("got"))

    def add(acc, x):
        start = acc["at"] + F.length(x["p"])
        end = start + F.length(x["m"])
        one = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m"))
        return F.when(x["m"].isNull(), acc).otherwise(F.struct(end.alias("at"), F.concat(acc["got"], F.array(one)).alias("got")))

    return F.aggregate(pairs, first, add, lambda acc: acc["got"])


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(acc, i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 0, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,m:string>>")


def base_entities(text: Column) -> dict[str, Column]:
    """Kind -> array of checked matches."""
    digits = lambda x: F.regexp_replace(x["m"], "[^0-9]", "")
    has_digit = text.rlike("[0-9]")
    found = {
        "email": F.when(text.contains("@"), _matches(text, EMAIL)).otherwise(_none()),
        "ip": F.when(text.rlike(r"[0-9]\.[0-9]"), _matches(text, IP)).otherwise(_none()),
        "card": F.when(has_digit, _matches(text, CARD)).otherwise(_none()),
        "phone": F.when(text.contains("+"), _matches(text, PHONE)).otherwise(_none()),
    }
    found["ip"] = F.filter(found["ip"], lambda x: x["m"].rlike(IP_PARTS))
    found["card"] = F.filter(found["card"], lambda x: _luhn(digits(x)))
    found["phone"] = F.filter(found["phone"], lambda x: F.length(digits(x)).between(8, 15))
    return found


def _spans(kind: str, matches: Column) -> Column:
    return F.transform(matches, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _let(value: Column, f) -> Column:
    """f(value), with ``value`` computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _pieces(text: Column) -> Column:
    """Tokens with the blanks after them, also cut after each of : = #; joined they are the text."""
    return F.split(text, r"(?<=[\s:=#])(?=\S)", -1)


def _word(piece: Column) -> Column:
    return F.lower(F.rtrim(piece, F.lit(" \t\n\x0b\f\r")))


def _context(text: Column, start: Column) -> Column:
    """Hash of the two words before ``start``, NULL if there are fewer; symbols glued to ``start`` are no word."""
    def last_two(p):
        a, b = _word(F.get(p, F.size(p) - 2)), _word(F.get(p, F.size(p) - 1))
        return F.when((F.size(p) >= 2) & (a != ""), F.xxhash64(a, b))

    def pieces(left):
        return _pieces(F.regexp_replace(left, r"(?<![^\p{L}0-9\s:=#])[^\p{L}0-9\s:=#]++$", ""))

    # of three pieces the last two are whole
    near = pieces(text.substr(F.greatest(F.lit(1), start - (NEAR - 1)), F.least(start, F.lit(NEAR))))
    return _let(near, lambda p: F.when((start <= NEAR) | (F.size(p) >= 3), last_two(p)))


def _value(raw: Column) -> Column:
    return F.lower(F.regexp_replace(raw, r"\s+", " "))


def _core(raw: Column) -> Column:
    return F.regexp_extract(raw, r"(?s)^(.*?)[^\p{L}0-9]*+$", 1)


def _letters(piece: Column) -> Column:
    return F.xxhash64(F.regexp_replace(F.lower(piece), r"[^\p{L}0-9]+", ""))


def _told_apart(rows: DataFrame, few: DataFrame) -> DataFrame:
    """``rows`` with ``__may``, false where ``__row`` is surely not in ``few``, so that only the others need a join.

    A bitmap of at most ``SLOTS`` bits goes to the tasks, whatever the number of rows; ones that share a slot are left to the join.
    """
    slot = F.pmod(F.xxhash64("__row"), F.lit(SLOTS))
    bit = F.expr("shiftleft(1L, CAST(__slot % 64 AS INT))")
    words = few.select(slot.alias("__slot")).groupBy(F.shiftright("__slot", 6).alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    held = F.coalesce(F.getbit("__bits", F.pmod(slot, F.lit(64)).cast("int")) == 1, F.lit(False))
    return rows.withColumn("__word", F.shiftright(slot, 6)).join(F.broadcast(words), "__word", "left").withColumn("__may", held).drop("__word", "__bits")


def _occurrences(texts: DataFrame, hits: DataFrame, raw) -> DataFrame:
    """Instances at ``hits`` (__row, pos of a piece, want); raw(tail, want) is what is taken of the text from there to the next seed."""
    hits = stored(hits, "pii-hits")
    texts = _told_apart(texts, hits).where("__may").drop("__may")
    hits = hits.groupBy("__row").agg(F.collect_set(F.struct("pos", "want")).alias("__hits"))   # bounded by one document
    found = texts.join(hits, "__row").withColumn("__pieces", _pieces(F.col("__text")))
    text, seeds = F.col("__text"), F.col("__seeds")

    def place(h):
        lead = F.length(F.regexp_extract(F.get("__pieces", h["pos"]), LEAD, 0))
        return F.struct((F.length(F.array_join(F.slice("__pieces", F.lit(1), h["pos"]), "")) + lead).alias("start"), h["want"].alias("want"))

    def take(h):
        later = F.array_min(F.transform(F.filter(seeds, lambda s: s["start"] >= h["start"]), lambda s: s["start"]))
        tail = text.substr(h["start"] + 1, F.coalesce(later, F.length(text)) - h["start"])
        # a token that runs into a seed is none
        core = _core(raw(_let(later, lambda at: F.when(at.isNull(), tail).otherwise(F.regexp_replace(tail, r"(?<!\S)\S++$", ""))), h["want"]))
        return _let(core, lambda core: F.struct(h["start"].alias("start"), (h["start"] + F.length(core)).alias("end"), _value(core).alias("value"), _context(text, h["start"]).alias("pattern"), h["want"].alias("want")))

    placed = F.filter(F.transform("__hits", place), lambda h: ~F.exists(seeds, lambda s: (s["start"] <= h["start"]) & (h["start"] < s["end"])))
    found = found.withColumn("__placed", placed).select("__row", F.explode(F.transform("__placed", take)).alias("o"))
    found = found.where((F.col("o.end") > F.col("o.start")) & (F.col("o.want").isNull() | (F.col("o.want") == F.col("o.value"))))
    wide = F.col("o.value").rlike("[0-9@]") & (F.length("o.value") >= WIDE)
    return found.select("__row", "o.start", "o.end", "o.value", F.xxhash64("o.value", F.lit(1)).alias("instance"), "o.pattern", wide.alias("wide"))


def _followed(texts: DataFrame, patterns: DataFrame, some: bool = False) -> DataFrame:
    """(__row, pos, pattern, first, plain) of each occurrence of ``patterns`` (pattern): what follows begins with the piece at pos.

    ``first`` is a hash of its letters and digits.  A ``plain`` piece is a whole word that touches no seed (no digit, no @, too
    short for a secret, a blank after it), so it is an instance by itself.  With ``some`` only the plain pieces of one
    hash range in ``RANGES``, told before patterns are looked up.
    """
    n = F.greatest(F.size("__pieces") - 2, F.lit(0))
    after = F.arrays_zip(F.slice("__words", F.lit(1), n).alias("a"), F.slice("__words", F.lit(2), n).alias("b"), F.slice("__pieces", F.lit(3), n).alias("c"))
    each = (texts.select("__row", _pieces(F.col("__text")).alias("__pieces")).withColumn("__words", F.transform("__pieces", _word))
            .select("__row", F.posexplode(F.transform(after, lambda x: F.struct(F.xxhash64(x["a"], x["b"]).alias("pattern"), x["c"].alias("c")))).alias("pos", "x"))
            .select("__row", (F.col("pos") + 2).alias("pos"), "x.pattern", "x.c"))
    piece = F.col("c")
    plain = piece.rlike(r"^[^0-9@]*\p{L}[^0-9@]*\s$") & (F.length(piece) < 32)
    each = each.select("__row", "pos", "pattern", _letters(piece).alias("first"), plain.alias("plain"))
    if some:
        each = each.where((F.pmod("first", F.lit(RANGES)) == 0) & F.col("plain"))
    return each.join(patterns, "pattern")


def _scored(score: DataFrame, values: DataFrame | None) -> DataFrame:
    """(first, m): how many scored instances that are no seeds begin with a piece."""
    if values is None:
        return score.select(F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("m")).limit(0)
    told = score.where("NOT seed AND score > 0").select("instance")
    known = values.join(told, "instance").select(_letters(F.get(_pieces(F.col("value")), F.lit(0))).alias("first"), "instance").distinct()
    return known.groupBy("first").agg(F.count(F.lit(1)).alias("m"))


def _can_reach(patterns: DataFrame, graph: DataFrame) -> DataFrame:
    """The (pattern, x, u) whose confidence can reach ``TRUST``: with k seeds before it, x scored instances that may follow it, all
    taken as sure, and u distinct plain words without a score after it, it is (k + x) / (k + x + u + 2) at most."""
    seeds = graph.where("seed").groupBy("pattern").agg(F.count(F.lit(1)).alias("k"))
    most = F.coalesce("k", F.lit(0)) + F.col("x")
    return patterns.join(seeds, "pattern", "left").where(most / (most + F.col("u") + 2) >= TRUST).select("pattern")


def _hopeful(patterns: DataFrame, sampled: DataFrame, graph: DataFrame, scored: DataFrame) -> DataFrame:
    """The ``patterns`` not left out by the words of one hash range alone, if every scored instance followed them."""
    x = scored.agg(F.sum("m")).first()[0] or 0
    u = sampled.join(scored, "first", "left_anti").groupBy("pattern").agg(F.count(F.lit(1)).alias("u"))
    return _can_reach(patterns.join(u, "pattern", "left").select("pattern", F.lit(x).cast("long").alias("x"), F.coalesce("u", F.lit(0)).alias("u")), graph)


def _may_be_trusted(found: DataFrame, graph: DataFrame, scored: DataFrame) -> DataFrame:
    """The patterns (pattern) of ``found`` (see :func:`_followed`) that can reach ``TRUST`` with the scores of this round.

    Distinct hashes are counted, no text is cut.
    """
    after = found.groupBy("pattern", "first").agg(F.max("plain").alias("plain")).join(scored, "first", "left")
    counts = after.groupBy("pattern").agg(F.coalesce(F.sum("m"), F.lit(0)).alias("x"), F.count_if(F.col("plain") & F.col("m").isNull()).alias("u"))
    return _can_reach(counts, graph)


def _after(texts: DataFrame, found: DataFrame, patterns: DataFrame) -> DataFrame:
    """What follows each occurrence of ``patterns`` (pattern) in ``found``."""
    hits = found.join(patterns, "pattern").select("__row", "pos", F.lit(None).cast("string").alias("want"))
    return _occurrences(texts, hits, lambda tail, want: F.regexp_extract(tail, RUN, 0))


def _again(texts: DataFrame, instances: DataFrame) -> DataFrame:
    """Each occurrence of ``instances`` (value), whatever is before it."""
    each = texts.select("__row", F.posexplode(F.transform(_pieces(F.col("__text")), _letters)).alias("pos", "first"))
    want = instances.select(_letters(F.get(_pieces(F.col("value")), F.lit(0))).alias("first"), F.col("value").alias("want"))
    hits = each.join(want, "first").select("__row", "pos", "want")
    tokens = lambda want: F.concat(F.lit(r"^\S++(?:[ \t]++\S++){"), (F.size(F.split(want, " ")) - 1).cast("string"), F.lit("}+"))
    return _occurrences(texts, hits, lambda tail, want: F.coalesce(F.regexp_substr(tail, tokens(want)), F.lit("")))


def _scores(graph: DataFrame, looked: DataFrame, accept: float) -> tuple[DataFrame, DataFrame]:
    """(instances with their scores, trusted patterns); only patterns of ``looked`` have all their instances in ``graph``.

    Scores only grow; they are passed on until a pass raises none by more than ``STEADY``.
    """
    score = stored(graph.groupBy("instance").agg(F.max("seed").alias("seed")).withColumn("score", F.col("seed").cast("double")), "pii-scores")
    full = stored(graph.join(looked, "pattern"), "pii-graph")
    while True:
        pattern = stored(full.join(score.select("instance", "score"), "instance").groupBy("pattern")
                         .agg((F.sum("score") / (F.count(F.lit(1)) + 2)).alias("conf"), F.count_if(F.col("score") >= accept).alias("support"))
                         .where((F.col("conf") >= TRUST) & (F.col("support") >= MIN_SUPPORT)), "pii-patterns")
        told = (full.join(pattern, "pattern").groupBy("instance").agg((1 - F.exp(F.sum(F.log(1 - F.least("conf", F.lit(0.999)))))).alias("told")))
        new = F.when(F.col("seed"), 1.0).otherwise(F.coalesce("told", F.lit(0.0)))
        score = stored(score.join(told, "instance", "left").select("instance", "seed", (new - F.col("score")).alias("more"), new.alias("score")), "pii-scores")
        if (score.agg(F.max("more")).first()[0] or 0.0) <= STEADY:
            return score.drop("more"), pattern
        score = score.drop("more")


def _touches(a: Column, spans: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < a["end"]) & (a["start"] < s["end"]))


def find_pii(docs: DataFrame, keep: list[str], accept: float = ACCEPT) -> DataFrame:
    """``keep`` columns of each row plus n_email, n_ip, n_card, n_phone, base and spans.

    base, spans: arrays of (kind, start, end), base kinds in their order, then ctx
    and secret, each by start.
    """
    text = F.col("__text")
    kept = "text" in keep
    rows = docs.select(*keep, text_of().alias("__text"))
    base = base_entities(text)
    rows = rows.withColumn("__base", F.concat(*[_spans(k, base[k]) for k in BASE_KINDS]))
    secret = F.when(text.rlike("[0-9A-Fa-f]{32}"), _matches(text, SECRET)).otherwise(_none())
    rows = rows.select(*keep, F.monotonically_increasing_id().alias("__row"), "__base", _spans("secret", secret).alias("__secret"), *[] if kept else ["__text"])
    # written once: row numbers, spans and texts are fixed even if an executor is lost
    rows = stored(rows, "pii-rows", compression="zstd")
    seeds = F.concat("__base", "__secret")
    texts = rows.select("__row", (text_of() if kept else text).alias("__text"), seeds.alias("__seeds"))
    one = lambda s: F.struct(_context(text, s["start"]).alias("pattern"), F.xxhash64(_value(text.substr(s["start"] + 1, s["end"] - s["start"])), F.lit(0)).alias("instance"))
    graph = stored(texts.where(F.size("__seeds") > 0).select(F.explode(F.transform("__seeds", one)).alias("o")).where("o.pattern IS NOT NULL")
                   .select("o.pattern", "o.instance", F.lit(True).alias("seed")).distinct(), "pii-graph")
    score = graph.select("instance", "seed", F.lit(1.0).alias("score")).distinct()
    looked = searched = seen = asked = sampled = found = None

    def add(old, new, name):
        return new if old is None else stored(old.unionByName(new), name)

    while True:
        known = score.where(F.col("score") >= accept)
        patterns = graph.join(known.select("instance"), "instance").groupBy("pattern").count().where(F.col("count") >= MIN_SUPPORT).select("pattern")
        patterns = stored(patterns if looked is None else patterns.join(looked, "pattern", "left_anti"), "pii-look")
        parts = []
        scored = stored(_scored(score, seen), "pii-scored")
        # one look at all texts for the words of a hash range, which leaves out all but few patterns, one for all that follows
        # the others; what was seen is asked again each round, with the scores of that round
        new = patterns if asked is None else stored(patterns.join(asked, "pattern", "left_anti"), "pii-new")
        if not new.isEmpty():
            some = stored(_followed(texts, new, some=True).select("pattern", "first").distinct(), "pii-some")
            asked, sampled = add(asked, new, "pii-asked"), add(sampled, some, "pii-sampled")
        hopeful = patterns if sampled is None else stored(_hopeful(patterns, sampled, graph, scored), "pii-hopeful")
        new = hopeful if found is None else stored(hopeful.join(found.select("pattern").distinct(), "pattern", "left_anti"), "pii-new")
        if not new.isEmpty():
            found = add(found, stored(_followed(texts, new), "pii-found"), "pii-found")
        if found is not None:
            patterns = stored(_may_be_trusted(found.join(hopeful, "pattern", "left_semi"), graph, scored), "pii-look")
            if not patterns.isEmpty():
                parts.append(_after(texts, found, patterns))
        else:
            patterns = hopeful.limit(0)
        if seen is not None:
            fresh = seen.where("wide").select("instance", "value").distinct().join(known.where("NOT seed").select("instance"), "instance")
            fresh = stored(fresh if searched is None else fresh.join(searched, "instance", "left_anti"), "pii-fresh")
            if not fresh.isEmpty():
                parts.append(_again(texts, fresh.select("value")))
                searched = fresh.select("instance") if searched is None else stored(searched.union(fresh.select("instance")), "pii-searched")
        if not parts:
            break
        for part in parts:
            seen = part if seen is None else seen.union(part)
        seen = stored(seen.distinct(), "pii-occurrences")
        looked = patterns if looked is None else stored(looked.union(patterns), "pii-looked")
        graph = stored(graph.where("seed").union(seen.where("pattern IS NOT NULL").select("pattern", "instance", F.lit(False)).distinct()), "pii-graph")
        score, trusted = _scores(graph, looked, accept)
    out = rows
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    if seen is None:
        out = out.withColumn("__ctx", none)
    else:
        new = stored(score.where((F.col("score") >= accept) & ~F.col("seed")).select("instance"), "pii-new")
        found = seen.join(new, "instance").join(trusted.select("pattern", F.lit(True).alias("told")), "pattern", "left").where("wide OR told")
        found = found.groupBy("__row").agg(F.sort_array(F.collect_set(F.struct(F.lit("ctx").alias("kind"), "start", "end"))).alias("__ctx"))   # bounded by one document
        # written before the join, so the planner knows its size; texts without a found span stay where they are
        found = stored(found, "pii-marked")
        out = _told_apart(out, found)
        out = (out.where("__may").drop("__may").join(found, "__row", "left")
               .unionByName(out.where("NOT __may").drop("__may").withColumn("__ctx", none)))
    extra = F.coalesce("__ctx", none)
    extra = F.concat(F.filter(extra, lambda x: ~_touches(x, seeds)), F.filter("__secret", lambda x: ~_touches(x, F.col("__base"))))
    count = lambda k: F.size(F.filter("__base", lambda s: s["kind"] == k)).cast("long")
    made = {f"n_{k}": count(k) for k in BASE_KINDS} | {"base": F.col("__base"), "spans": F.concat("__base", extra)}
    return out.select(*[c for c in keep if c.lower() not in made], *[v.alias(k) for k, v in made.items()])


def redact(docs: DataFrame, mark: str = "[{}]") -> DataFrame:
    """``docs`` with every span in text replaced by its kind; columns stay, n_chars follows the new text."""
    found = find_pii(docs, docs.columns)
    spans = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col("text")

    def add(acc, s):
        # a span that begins inside the one before is covered by its mark
        piece = F.concat(acc["out"], text.substr(acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"])),
                         F.when(s["start"] >= acc["at"], F.format_string(mark.replace("{}", "%s"), s["kind"])).otherwise(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), piece.alias("out"))

    clean = F.aggregate(spans, first, add, lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.length(text))))
    out = found.withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
