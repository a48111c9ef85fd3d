"""Secrets in texts: three patterns, and two character Markov models compared by likelihood.

Everything runs as column expressions. Matches of a pattern are placed by adding
up the lengths of what lies between them, so positions are code points.

The Markov part scores long tokens that hold a digit and a letter: the log
likelihood of the token's character pairs under a model of random strings, less
that under a model of ordinary identifiers. Both are tables of pair counts
trained from labelled samples, with one added to every pair. A token is
reported if its ratio is large enough in all and per character, and if it does
not overlap a match of the patterns.

Defined results: a null text is empty and has no spans; rows are independent of
each other, equal ones give equal results; other columns are never read. A text
without spans has the empty text as ``spans``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The base patterns, and the shortest match (of group 2 for assign) that counts.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LEAST = 18
HEX = r"[0-9a-f]+"
HEX_LEAST = 16

KINDS = ("assign", "access", "hex", "markov")
TOKEN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
FIRST, CODES = 32, 96
PER_CHARACTER, IN_ALL = 1.0, 22.0
SAMPLE_RANDOM = 6000
SAMPLE_NAMES = 400
STRIDE = 32
# Labelled samples of ordinary words, of which names are made.
ORDINARY = """
    get set user name order price total count index value item list array string number date time year month day file path
    folder image page page title text content body header footer button color width height size length start end begin
    finish open close read write load save delete update insert select create remove add find search filter sort group
    customer account address email phone city country street region company product category service server client
    request response message error warning status code type kind class object method function variable constant default
    config setting option parameter argument result output input source target table column row field record key
    database query connection session context manager handler factory builder wrapper helper utils common core main
    test example sample report final version release module package library project website article comment question
    answer network system process thread memory storage buffer cache queue stack tree node graph edge layer model
    http html json xml servlet java script python android windows google amazon github document annual monthly summary
    the and for with from that this have been which their would there about other after first could these also into
""".split()
_NONE = "cast(array() as array<struct<start:int,end:int,hit:string>>)"


_CODES = f"transform(split(text, ''), c -> if(ascii(c) between {FIRST} and {FIRST + CODES - 1}, ascii(c) - {FIRST}, 0))"
_PAIRS = f"transform(array({_CODES}), c -> zip_with(slice(c, 1, size(c) - 1), slice(c, 2, size(c) - 1), (a, b) -> a * {CODES} + b))[0]"


def _text(sql: str) -> str:
    """A SQL string literal."""
    return "'" + sql.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """``body``, in which ``name`` stands for ``value``, worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _before(values: str, zero: int, join: str, levels: int = 2) -> str:
    """By place of an array of numbers: all values before it joined by ``join``, an expression of two.

    A running list that grows by one value at a time is copied at each. So values
    are taken in blocks of ``STRIDE``, the blocks' own totals in blocks again, and
    what is copied stays a constant number of values for each.
    """
    v, k, t, at = (f"{n}{levels}" for n in ("v", "k", "t", "at"))
    total = f"aggregate({k}, {zero}, (s, x) -> {join.format('s', 'x')})"
    run = f"""aggregate({k}, named_struct('s', {{}}, 'out', cast(array() as array<int>)),
        (r, x) -> named_struct('s', {join.format('r.s', 'x')}, 'out', concat(r.out, array(r.s))), r -> r.out)"""
    if not levels:
        return _let(k, values, run.format(zero))
    blocks = f"transform(sequence(0, (size({v}) - 1) div {STRIDE}), b -> slice({v}, b * {STRIDE} + 1, {STRIDE}))"
    totals = _before(f"transform({t}, {k} -> {total})", zero, join, levels - 1)
    return _let(v, values, _let(t, blocks, f"flatten(zip_with({t}, {totals}, ({k}, {at}) -> {run.format(at)}))"))


def places(text: str, pattern: str, gate: str, keep: str = "true") -> Column:
    """Matches of ``pattern`` in the named column, leftmost and apart, as (start, end, hit); ``keep`` is a condition on ``hit``.

    Only texts in which ``gate`` occurs are cut up. A match begins where the texts
    between the matches and the matches before it end.
    """
    p = _text(pattern)
    cut = f"zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), (gap, hit) -> struct(length(gap) as gap, hit))"
    before = _before("transform(p, y -> y.gap + coalesce(length(y.hit), 0))", 0, "{} + {}")
    put = f"zip_with(p, {before}, (y, at) -> named_struct('start', at + y.gap, 'end', at + y.gap + length(y.hit), 'hit', y.hit))"
    placed = _let("p", cut, f"filter({put}, y -> y.hit is not null and ({keep.replace('hit', 'y.hit')}))")
    return F.expr(f"case when rlike({text}, {_text(gate)}) then {placed} else {_NONE} end")


def apart(spans: str, others: str) -> str:
    """Those of the array ``spans`` (start, end, hit) that overlap none of ``others``: SQL, without comparing each with each.

    In the order of their starts, a span overlaps one that begins before it if that ends later than it begins, and
    one that begins after it if that begins before it ends.
    """
    far = 2 ** 31 - 1
    marked = f"transform({{}}, y -> named_struct('start', y.start, 'own', {{}}, 'end', y.end, 'hit', y.hit))"
    events = f"array_sort(concat({marked.format(others, 0)}, {marked.format(spans, 1)}))"
    ended = _before("transform(e, y -> if(y.own = 0, y.end, 0))", 0, "greatest({}, {})")
    begun = f"reverse({_before(f'reverse(transform(e, y -> if(y.own = 0, y.start, {far})))', far, 'least({}, {})')})"
    free = f"""zip_with(zip_with(e, {ended}, (y, last) -> named_struct('y', y, 'last', last)), {begun},
        (z, next) -> if(z.y.own = 1 and z.last <= z.y.start and next >= z.y.end, named_struct('start', z.y.start, 'end', z.y.end, 'hit', z.y.hit), null))"""
    return _let("e", events, f"filter({free}, y -> y is not null)")


def pair_counts(samples: DataFrame) -> DataFrame:
    """(random, pair, n) of all character pairs in ``samples`` (text, random); other characters than printable ASCII count as a space."""
    pairs = samples.where("length(text) > 1").select("random", F.explode(F.expr(_PAIRS)).alias("pair"))
    return pairs.groupBy("random", "pair").agg(F.count("*").alias("n"))


def word_pairs(docs: DataFrame, text_name: str = "text") -> DataFrame:
    """(random: false, pair, n) of the character pairs in all words of all texts; words are counted first, with map-side combine."""
    words = docs.select(F.explode(F.regexp_extract_all(F.col(f"`{text_name}`"), F.lit("[A-Za-z]{3,24}"), F.lit(0))).alias("text"))
    counted = words.groupBy("text").agg(F.count("*").alias("times"))
    pairs = counted.select("times", F.explode(F.expr(_PAIRS)).alias("pair"))
    return pairs.groupBy("pair").agg(F.sum("times").alias("n")).select(F.lit(False).alias("random"), "pair", "n")


def train(samples: DataFrame, words: DataFrame | None = None) -> list[int]:
    """Log ratio of each character pair, in thousandths; a table of CODES x CODES whatever the samples.

    ``words`` are more pairs of ordinary text. They weigh as much as the ordinary samples, however many there are, so
    that what joins words in names stays known.
    """
    counts: dict[bool, dict[int, float]] = {True: {}, False: {}}
    for random, pair, n in pair_counts(samples).collect():
        counts[random][pair] = n
    if words is not None and (more := {pair: n for _, pair, n in words.collect()}):  # CODES x CODES rows at most
        share = (sum(counts[False].values()) or 1) / sum(more.values())
        for pair, n in more.items():
            counts[False][pair] = counts[False].get(pair, 0) + n * share
    seen = sorted({p % CODES for c in counts.values() for p in c} | {p // CODES for c in counts.values() for p in c})
    width = max(len(seen), 1)
    logs = {}
    for kind, c in counts.items():
        total: dict[int, float] = {}
        for p in sorted(c):
            total[p // CODES] = total.get(p // CODES, 0) + c[p]
        logs[kind] = [math.log((c.get(p, 0) + 1) / (total.get(p // CODES, 0) + width)) for p in range(CODES * CODES)]
    return [round(1000 * (a - b)) for a, b in zip(logs[True], logs[False])]


def random_strings(spark: SparkSession, rows: int = SAMPLE_RANDOM) -> DataFrame:
    """Samples of random strings in four alphabets, the same in every run."""
    digest = "sha2(concat('random', cast(id as string)), 512)"
    long = f"base64(unhex({digest}))"
    return spark.range(rows).select(F.expr(f"""
        substring(case id % 4
            when 0 then {long}
            when 1 then regexp_replace({long}, '[+/=]', '')
            when 2 then upper(regexp_replace({long}, '[+/=]', ''))
            else {digest} end, 1, cast(20 + id % 23 as int))""").alias("text"), F.lit(True).alias("random"))


def identifiers(spark: SparkSession, rows: int = SAMPLE_NAMES) -> DataFrame:
    """Samples of ordinary identifiers: common words, alone and joined as names are, the same in every run."""
    drawn = spark.range(rows).select(F.expr(
        f"transform(sequence(0, 199), i -> element_at(split('{' '.join(ORDINARY)}', ' '), cast(pmod(xxhash64(id, i), {len(ORDINARY)}) as int) + 1))").alias("w"))
    names = F.expr("""flatten(transform(w, (x, i) -> array(
        x,
        concat_ws('_', lower(x), lower(coalesce(get(w, i + 1), 'id')), cast(i as string)),
        concat(lower(x), initcap(coalesce(get(w, i + 1), 'Id')), initcap(coalesce(get(w, i + 2), 'Key'))),
        concat_ws('-', lower(x), coalesce(get(w, i + 1), 'v'), cast(1990 + i % 40 as string)),
        concat_ws('/', x, coalesce(get(w, i + 1), 'index'), coalesce(get(w, i + 2), 'page')),
        upper(concat_ws('_', x, coalesce(get(w, i + 1), 'MAX'))))))""")
    return drawn.select(F.explode(names).alias("text"), F.lit(False).alias("random"))


def scan(docs: DataFrame, model: list[int], text_name: str = "text", per_character: float = PER_CHARACTER, in_all: float = IN_ALL) -> DataFrame:
    """``docs`` as struct column _doc, with arrays _assign, _access, _hex and _markov of (start, end, hit)."""
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), F.coalesce(F.col(text_name), F.lit("")).alias("_text"))
    based = packed.select(
        "_doc",
        places("_text", ASSIGN, "(?i:password|passwd|secret|token|api_?key)", f"length(regexp_extract(hit, {_text(ASSIGN)}, 2)) >= {ASSIGN_LEAST}").alias("_assign"),
        places("_text", ACCESS, "AKIA", f"length(hit) >= {ACCESS_LEAST}").alias("_access"),
        places("_text", f"[0-9a-f]{{{HEX_LEAST},}}", f"[0-9a-f]{{{HEX_LEAST}}}").alias("_hex"),
        places("_text", TOKEN, TOKEN).alias("_token"),
    )
    table = f"cast(split('{' '.join(map(str, model))}', ' ') as array<int>)"
    ratio = f"""aggregate(
        zip_with(slice(split(t.hit, ''), 1, length(t.hit) - 1), slice(split(t.hit, ''), 2, length(t.hit) - 1),
            (a, b) -> get({table}, (ascii(a) - {FIRST}) * {CODES} + ascii(b) - {FIRST})),
        0L, (s, x) -> s + x)"""
    least = f"greatest({int(1000 * in_all)}, {int(1000 * per_character)} * (length(t.hit) - 1))"
    free = apart("_token", "concat(_assign, _access, _hex)")
    markov = F.expr(f"case when size(_token) = 0 then {_NONE} else filter({free}, t -> {ratio} >= {least}) end")
    return based.select("_doc", "_assign", "_access", "_hex", markov.alias("_markov"))


def spans(*kinds: str) -> Column:
    """kind:start:end of the named columns by start, then by kind, comma-joined."""
    parts = [f"transform(_{k}, x -> named_struct('start', x.start, 'rank', {KINDS.index(k)}, 'end', x.end, 'kind', '{k}'))" for k in kinds]
    return F.expr(f"array_join(transform(array_sort(concat({', '.join(parts)})), x -> concat_ws(':', x.kind, cast(x.start as string), cast(x.end as string))), ',')")


def find(docs: DataFrame, text_name: str = "text") -> DataFrame:
    """``scan`` with models trained on random strings, and on identifiers and all words of ``docs``."""
    samples = random_strings(docs.sparkSession).union(identifiers(docs.sparkSession))
    return scan(docs, train(samples, word_pairs(docs, text_name)), text_name)
