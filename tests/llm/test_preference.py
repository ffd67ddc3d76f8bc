import duckdb

from lineflow.llm import preference
from lineflow.llm.queries import ORACLES, QUERIES


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    duckdb.sql(f"create or replace view conversations as select * from read_parquet('{sf_dir}/conversations.parquet')")
    found = duckdb.sql(ORACLES["op10_preference"])
    got = QUERIES["op10_preference"](spark, sf_dir)
    assert got.columns == found.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, found.fetchall()))


def plain(pair):
    chosen, rejected = pair
    n = 0
    while chosen and rejected and n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    show = lambda ts: "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in ts)
    mask = lambda ts: "".join("0" * len(f"<|{r or ''}|>\n") + ("1" if r == "assistant" else "0") * len(f"{t or ''}<|end|>\n") for r, t in ts)
    side = lambda ts: (None, None) if ts is None else (show(ts[n:]), mask(ts[n:]))
    return (show((chosen or [])[:n]), n, *side(chosen), *side(rejected))


def test_odd_pairs(spark):
    a, b, c = ("user", "hi"), ("assistant", "yes 😀"), ("assistant", "no")
    pairs = [([a, b], [a, c]), ([a, b], [a, b]), ([a], [a, b]), ([a, b], None), (None, [c]), ([b], [c]), ([a, b, a, c], [a, b, a, b]), ([(None, None)], [(None, "x")]), ([("user", "long " * 50_000)], [a]), ([], [a])]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "prompt_id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")
    got = {r.prompt_id: tuple(r)[1:] for r in preference.format_pairs(rows).collect()}
    assert got == {i: plain(p) for i, p in enumerate(pairs)}


def test_pairing_odd_turns(spark):
    schema = "conv_id long, turn long, role string, text string, chosen string"
    rows = [(0, 0, "user", "q", "x"), (0, 0, "user", "q", "x"), (0, 1, None, None, "x"), (1, 0, "user", "q", None), (5, None, "user", "z", "x"), (5, None, "user", "z", "x"), (None, 0, "user", "q", "x")]
    got = {r.pair_id: r for r in preference.adjacent_pairs(spark.createDataFrame(rows, schema)).collect()}
    assert sorted(got) == [0, 2]
    assert [tuple(t) for t in got[0].chosen] == [("user", "q"), ("user", "q"), ("", "")] and len(got[0].rejected) == 1
    assert got[2].chosen is None and [tuple(t) for t in got[2].rejected] == [("user", "z")] * 2
    assert preference.format_pairs(preference.adjacent_pairs(spark.createDataFrame([], schema))).count() == 0


def test_clashing_names(spark):
    kind = "array<struct<role:string,text:string>>"
    rows = spark.createDataFrame([([("user", "a")], [("user", "a"), ("user", "b")], *"uvwxyz")], f"chosen {kind}, rejected {kind}, prompt string, __n string, n string, c string, others string, chosen_mask string")
    got = preference.format_pairs(rows)
    assert got.columns == ["__n", "n", "c", "others", "prompt", "n_prompt_turns", "chosen", "chosen_mask", "rejected", "rejected_mask"]
    assert tuple(got.first())[:6] == (*"vwxy", "<|user|>\na<|end|>\n", 1)
