"""Personal data: patterns, and terms that give protected entities away.

Base spans are found by pattern. The method then asks how strongly other terms of the
corpus reveal an entity (one value of a base span): with document frequencies over
distinct texts, the disclosure of entity e by term t is PMI(e; t) / IC(e), 1 if t never
occurs without e. Terms at or over a threshold are added as spans wherever they occur;
in clean text base spans and revealing terms are replaced by their kind, and terms that
reveal fully are removed.

Most entities occur in fewer than `support` distinct texts, where each word of the text
would reveal them. Such an entity is counted as its class: the finest of mail domain,
network or number prefix, then kind, then any personal data, that occurs in `support` texts.

Only DataFrame functions are used. Candidate terms are thinned by counts of single terms
before (entity, term) pairs are made: the term has to occur in `support` distinct texts
with entities, which must be a large enough share of all texts it occurs in.

Results in odd cases: null texts are empty ones and have no spans; repeated texts count
once as evidence and all get the same spans; repeated rows each give a row; an empty
table gives no rows; other columns are not looked at and stay, whatever their names, but
for columns with the names of find()'s results, which these replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineflow.llm.common import cut

KINDS = ["email", "ip", "card", "phone", "term"]
#: Distinct texts that an entity or class, and it together with a term, must occur in.
SUPPORT = 3
#: PMI / IC from which a term counts as revealing.
DISCLOSURE = 0.95
#: Classes in more texts than this are joined apart from the others, as they are few enough for a broadcast even where those are not.
HOT_TEXTS = 10_000
#: Lists of terms or of texts' hashes are broadcast up to this many rows, and joined by a shuffle beyond it.
BROADCAST_ROWS = 200_000

_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"
_LOCAL = "[A-Za-z0-9._%+-]"
#: The plain patterns with possessive repeats, and with looks behind so that a run of
#: characters is tried from its start only; they match the same spans.
_EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_WORD = r"[^\p{L}]+"


def _none() -> Column:
    return F.expr(f"cast(array() as {_SPANS})")


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(_digits(hit)), ""), lambda c, i: F.try_to_number(c, F.lit("9")).cast("int") * (F.lit(1) + i % 2))
    return F.aggregate(doubled, F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0)) - F.when(v > 9, 9).otherwise(0)) % 10 == 0


def _found(text: Column, pattern: Column, kind: int, valid, value) -> Column:
    """Spans of the matches that are valid, with code point positions: what lies between matches and the matches are summed up."""
    zero = F.struct(F.lit(0).alias("at"), _none().alias("spans"))
    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0)), lambda p, h: F.struct(F.length(p).alias("gap"), h.alias("hit")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value(x["hit"]).alias("value"))
        kept = F.when(x["hit"].isNotNull() & valid(x["hit"]), F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    return F.aggregate(parts, zero, step, lambda acc: acc["spans"])


def base_spans(text: Column) -> Column:
    """Valid e-mail addresses, IPs, cards and phone numbers of a text that isn't null, by start, then kind."""
    octets = lambda h: F.forall(F.split(h, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 4).try_cast("int"), F.lit(0)) <= 255))
    found = [
        F.when(F.contains(text, F.lit("@")), _found(text, F.lit(_EMAIL), 0, lambda h: F.lit(True), F.lower)),
        F.when(text.rlike(r"[0-9]\.[0-9]+\.[0-9]"), _found(text, F.lit(_IP), 1, octets, lambda h: h)),
        F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), _found(text, F.lit(_CARD), 2, _luhn, _digits)),
        F.when(F.contains(text, F.lit("+")), _found(text, F.lit(_PHONE), 3, lambda h: F.length(_digits(h)).between(9, 15), _digits)),
    ]
    return F.array_sort(F.concat(*(F.coalesce(x, _none()) for x in found)))


def spans_string(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def _terms(text: Column) -> Column:
    """Distinct words of three letters or more, outside base spans; of these only addresses hold letters."""
    text = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, _EMAIL, " ")).otherwise(text)
    return F.array_distinct(F.filter(F.split(F.lower(text), _WORD), lambda w: F.length(w) >= 3))


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({"__text": text, "__h": F.xxhash64(text), "__g": F.xxhash64(F.lit(1), text)})


def _levels(entity: Column) -> Column:
    """(level, kind, value) of an entity itself and of its classes, from fine to coarse."""
    kind, value = entity["kind"], entity["value"]
    fine = F.when(kind == 0, F.substring_index(value, "@", -1)).when(kind == 1, F.substring_index(value, ".", 2)).when(kind == 2, F.substring(value, 1, 6)).otherwise(F.substring(value, 1, 4))
    nothing = F.lit("")
    levels = [(kind, value), (kind, fine), (kind, nothing), (F.lit(-1), nothing)]
    return F.array(*(F.struct(F.lit(i).alias("level"), k.alias("kind"), v.alias("value")) for i, (k, v) in enumerate(levels)))


def _pooled(held: DataFrame, support: int) -> DataFrame:
    """(h, g, entity) -> (h, g, entity, n_entity), entities of too few texts replaced by the finest class of enough texts."""
    pools = cut(held.select("h", "g", F.explode(_levels(F.col("entity"))).alias("pool")).distinct())
    sizes = cut(pools.groupBy("pool").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= support))
    listed = held.select("entity").distinct().select("entity", F.explode(_levels(F.col("entity"))).alias("pool"))
    hot = _small(sizes.where(F.col("n_entity") > HOT_TEXTS))
    rest = _small(cut(sizes.where(F.col("n_entity") <= HOT_TEXTS)))
    enough = listed.join(hot, "pool").unionByName(listed.join(rest, "pool"))
    chosen = cut(enough.groupBy("entity").agg(F.min("pool").alias("pool")).select("pool").distinct().join(sizes, "pool"))
    hot = _small(chosen.where(F.col("n_entity") > HOT_TEXTS))
    rest = _small(cut(chosen.where(F.col("n_entity") <= HOT_TEXTS)))
    return pools.join(hot, "pool").unionByName(pools.join(rest, "pool")).withColumnRenamed("pool", "entity")


def revealing_terms(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE, text_col: str = "text") -> DataFrame | None:
    """(h, g, term, reveals): texts, by two hashes, with the revealing terms they hold; None if too few texts hold entities.

    Of several entities the one that the term reveals most counts.
    """
    rows = _keyed(docs.select(F.col(f"`{text_col}`").alias("text")), "text").select(F.col("__h").alias("h"), F.col("__g").alias("g"), F.col("__text").alias("text"))
    values = F.array_distinct(F.transform(base_spans(F.col("text")), lambda s: F.struct(s["kind"].alias("kind"), s["value"].alias("value"))))
    held = cut(rows.select("h", "g", F.explode(values).alias("entity")).distinct())
    held = cut(_pooled(held, support))
    if held.isEmpty():
        return None
    # frequencies of single terms over distinct texts: each of several copies counts as a part of one
    copies = cut(rows.groupBy("h", "g").agg(F.count("*").alias("copies")))
    n_texts = copies.count()
    weighed = rows.join(_small(copies.where("copies > 1")), ["h", "g"], "left").withColumn("weight", F.lit(1.0) / F.coalesce("copies", F.lit(1)))
    weighed = weighed.join(_small(cut(held.select("h", "g", F.lit(1).alias("near")).distinct())), ["h", "g"], "left")
    listed = weighed.select("weight", "near", F.explode(_terms(F.col("text"))).alias("term"))
    counts = listed.groupBy("term").agg(F.sum("weight").alias("n_term"), F.sum(F.when(F.col("near") == 1, F.col("weight"))).alias("n_near"))
    counts = counts.select("term", F.round("n_term").cast("long").alias("n_term"), F.round("n_near").cast("long").alias("n_near"))
    least = (support / max(n_texts, support)) ** (1 - disclosure)  # of n_entity_term / n_term, for the rarest entity
    counts = cut(counts.where((F.col("n_near") >= support) & (F.col("n_near") >= F.col("n_term") * least - 1e-9)))
    # where the terms that are left occur, and with which entities
    where = cut(rows.select("h", "g", F.explode(_terms(F.col("text"))).alias("term")).join(_small(counts), "term").groupBy("h", "g", "term").agg(F.first("n_term").alias("n_term")))
    able = F.col("n_term") <= F.col("n_entity") * F.pow(F.lit(float(n_texts)) / F.col("n_entity"), F.lit(1 - disclosure)) + 1e-6  # the highest n / n_entity is 1
    pairs = where.join(held, ["h", "g"]).where(able).groupBy("entity", "term").agg(F.count("*").alias("n"), F.first("n_term").alias("n_term"), F.first("n_entity").alias("n_entity")).where(F.col("n") >= support)
    pmi = F.log2(F.lit(float(n_texts)) * F.col("n") / (F.col("n_entity") * F.col("n_term")))
    information = F.log2(F.lit(float(n_texts)) / F.col("n_entity"))
    reveals = pairs.select("term", F.when(information > 0, pmi / information).otherwise(0.0).alias("reveals")).groupBy("term").agg(F.max("reveals").alias("reveals"))
    reveals = reveals.where(F.col("reveals") >= disclosure - 1e-9)
    return cut(where.select("h", "g", "term").join(reveals, "term"))


def _small(df: DataFrame) -> DataFrame:
    """Marks df for broadcast if it has BROADCAST_ROWS rows at most; else Spark joins by a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def find(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE, text_col: str = "text") -> DataFrame:
    """docs with __base and __spans (arrays of start, kind, end, value) and __removed (fully revealing terms)."""
    results = ["__base", "__spans", "__removed"]
    kept = [c for c in docs.columns if c not in results]
    row = F.struct(F.lit(0), *(F.col(f"`{c}`") for c in kept if c != text_col)).alias("row")
    marked = _keyed(docs.select(row, F.col(f"`{text_col}`").alias("text")), "text").drop("__text")
    terms = revealing_terms(docs, support, disclosure, text_col)
    whole, nothing = F.coalesce("text", F.lit("")), F.expr("cast(array() as array<string>)")
    if terms is None:
        marked = marked.withColumn("__base", base_spans(whole)).withColumns({"__spans": F.col("__base"), "__removed": nothing})
    else:
        by_text = terms.groupBy(F.col("h").alias("__h"), F.col("g").alias("__g")).agg(
            F.array_sort(F.collect_set("term")).alias("__terms"), F.collect_set(F.when(F.col("reveals") > 1 - 1e-9, F.col("term"))).alias("__removed")
        )
        marked = marked.join(by_text, ["__h", "__g"], "left").withColumn("__base", base_spans(whole))
        pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("__terms", "|"), F.lit(r")(?!\p{L})"))
        added = F.when(F.col("__terms").isNotNull(), _found(whole, pattern, 4, lambda h: F.lit(True), F.lower))
        apart = F.filter(F.coalesce(added, _none()), lambda t: ~F.exists("__base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
        marked = marked.withColumns({"__spans": F.array_sort(F.concat("__base", apart)), "__removed": F.coalesce("__removed", nothing)})
    return marked.select(*((F.col("text") if c == text_col else F.col("row").getField(c)).alias(c) for c in kept), *results)


def clean(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE, text_col: str = "text") -> DataFrame:
    """docs, same columns, with spans in the text generalised to [EMAIL], [IP], [CARD], [PHONE] or [TERM], or removed."""
    text = F.col(f"`{text_col}`")
    rest_of_row = F.struct(F.lit(0), *(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("row")
    found = find(docs.select(rest_of_row, text.alias("text")), support, disclosure, "text")
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    text, removed = F.coalesce("text", F.lit("")), F.col("__removed")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        name = F.when((s["kind"] == 4) & F.array_contains(removed, s["value"]), "").otherwise(names[s["kind"]])
        covered = s["end"] <= acc["at"]  # within a span of another kind
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(covered, acc["out"]).otherwise(F.concat(acc["out"], between, name)).alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    replaced = F.when(F.size("__spans") > 0, F.aggregate("__spans", zero, step, rest)).otherwise(F.col("text"))
    return found.select(*(replaced.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))
