"""The pipeline, stage by stage, against plain Python; registration of the queries."""

import collections

import pytest
import sentencepiece
from conftest import SF_SMALL
from test_llm_lines_mixing import LOWER, plain_mix
from test_llm_near_duplicates import plain_join

import __spark_entry__ as entry
import corpus_pipeline
from shelfwise.llm import mixing, queries, toxicity
from shelfwise.llm.common import table


def plain_texts(rows, min_chars=40, min_docs=5):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = collections.defaultdict(set)
    for i, text in rows.items():
        for x in (text or "").split("\n"):
            if len(key(x)) >= min_chars:
                holders[key(x)].add(i)
    bad = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    return {i: "\n".join(x for x in (t or "").split("\n") if bad.get(key(x), i) == i) for i, t in rows.items()}


def test_stages_against_plain_python(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents")
    columns, kept = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = kept
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(str(tmp_path / f"{k}"))
        docs = spark.read.parquet(str(tmp_path / f"{k}"))
        rows = docs.collect()
        kept = {r["doc_id"]: r for r in rows}
        assert len(kept) == len(rows)
        if name != "sentencepiece":
            assert docs.columns == columns
        if name == "toxicity":
            full = table(spark, SF_SMALL, "documents")
            model = toxicity.fit_toxicity(full, table(spark, SF_SMALL, "labels"))
            bad = {r["doc_id"] for r in toxicity.predict_toxicity(full, model).where("toxic").collect()}
            assert bad and set(kept) == set(before) - bad
            truth = {r["doc_id"]: r["toxic"] for r in table(spark, SF_SMALL, "labels").collect()}
            assert all(truth.get(i, 0) for i in bad if i in truth)
        elif name == "line_dedup":
            want = plain_texts({i: r["text"] for i, r in before.items()})
            assert {i: r["text"] for i, r in kept.items()} == want
            assert all(r["n_chars"] == len(r["text"]) for i, r in kept.items() if r["text"] != before[i]["text"])
        elif name == "near_duplicates":
            want = plain_join([(i, r["text"]) for i, r in before.items()])
            assert set(kept) == {i for i, _, c in want if i == c} | {i for i, _, c in want if c is None}
            assert all(kept[i] == before[i] for i in kept)
        elif name == "mixing":
            assert kept == before
            names = sorted({r["source"] for r in kept.values()})
            counts = [sum(r["source"] == s for r in kept.values()) for s in names]
            units = mixing.cycle_units(counts, [n**0.5 for n in counts], 256)
            assert [r["source"] for r in out.collect()] == [names[i] for i in plain_mix(counts, units, 16)]
        else:
            sp = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
            assert set(kept) == set(before)
            assert all(r["ids"] == sp.encode(before[i]["text"]) and r["n_tokens"] == len(r["ids"]) and r["round_trip"]
                       for i, r in kept.items())


def test_run_gives_one_row_per_kept_document(spark):
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert 0 < len(out) == len({r["doc_id"] for r in out}) < table(spark, SF_SMALL, "documents").count()


def test_stages_take_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "x y", "en", "s", 3), (1, "x y", "en", None, 3), (1, "x y", "en", None, 3), (2, "", None, "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == df.columns
    assert collections.Counter(map(tuple, docs.collect())) == collections.Counter(rows[:3] + rows[4:])
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == 4
    empty = df.limit(0)
    assert all(stage(spark, empty, SF_SMALL).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_rows_are_judged_by_their_own_text(spark):
    """Ids that several texts share, null ids, toxic copies, clashing column names."""
    docs = table(spark, SF_SMALL, "documents")
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF_SMALL, "labels").collect()}
    model = toxicity.fit_toxicity(docs, table(spark, SF_SMALL, "labels"))
    full = docs.collect()
    is_bad = {r["doc_id"] for r in toxicity.predict_toxicity(docs, model).where("toxic").collect()}
    bad = next(r for r in full if r["doc_id"] in is_bad and labels.get(r["doc_id"]))
    clean = next(r for r in full if r["doc_id"] not in is_bad and len(r["text"]) > 800)
    twin = " ".join(clean["text"].split()[3:])
    line = "A line that more than four documents hold, and that is long enough"
    rows = [tuple(r) for r in full] + [(clean["doc_id"], bad["text"], "en", "s", 1), (bad["doc_id"], "a clean text under the id of a toxic one", "en", "s", 1),
                                       (None, bad["text"], "en", "s", 1), (None, "null id, clean", "en", "s", 1)]
    rows += [(9_000_000 + i, f"opening {i}\n{line}", "en", "s", 1) for i in range(6)]
    rows += [(9_000_000, "second text of an id\nwithout the line", "en", "s", 1), (9_000_005, f"third {line}\n{line}", "en", "s", 1),
             (9_000_010, twin, "en", "s", 1), (9_000_010, "not a twin at all, but of the same id", "en", "s", 1)]
    names = ["_bad", "_id", "_gone", "_n", "_mix_id", "_mix_at", "gone", "row", "kept_text", "position", "n"]
    df = spark.createDataFrame([(*r, *range(i, i + len(names))) for i, r in enumerate(rows)],
                               "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names))
    stage = dict(corpus_pipeline.STAGES)
    out = stage["toxicity"](spark, df, SF_SMALL)
    fitted = toxicity.fit_toxicity(df.select(*docs.columns), table(spark, SF_SMALL, "labels"))
    calm = {i for i, r in enumerate(rows) if not fitted.tail(r[1])[0] >= fitted.threshold}
    got = out.collect()
    assert out.columns == df.columns and {r["_bad"] for r in got} == calm and len(got) == len(calm) < len(rows)
    assert all(tuple(r)[:5] == rows[r["_bad"]] for r in got)
    out = stage["line_dedup"](spark, df, SF_SMALL)
    got = {r["_bad"]: r for r in out.collect()}
    assert out.columns == df.columns and len(got) == len(rows)
    at = len(full) + 4
    assert [got[at + i]["text"] for i in range(6)] == [*(f"opening {i}" for i in range(5)), f"opening 5\n{line}"]
    assert got[at + 6]["text"] == rows[at + 6][1] and got[at + 7]["text"] == rows[at + 7][1]
    assert all(got[i]["n_chars"] == len(got[i]["text"]) for i in range(at, at + 5))
    out = stage["near_duplicates"](spark, df, SF_SMALL)
    left = {r["_bad"] for r in out.collect()}
    number = {i: n for n, i in enumerate(sorted((i for i, r in enumerate(rows) if r[0] is not None), key=lambda i: (rows[i][0], i)))}
    groups = plain_join([(number[i], rows[i][1]) for i in number])
    label = {i: c for i, _, c in groups}
    members = collections.defaultdict(list)
    for i in number:
        members[label[number[i]] if label[number[i]] is not None else ("own", i)].append(i)
    assert out.columns == df.columns and all(sum(i in left for i in m) == 1 for m in members.values())
    assert all(min(rows[i][0] for i in m) == rows[next(i for i in m if i in left)][0] for m in members.values())
    assert {len(full) + 2, len(full) + 3} <= left and at + 9 in left and at + 8 not in left
    out = stage["mixing"](spark, df, SF_SMALL)
    assert out.columns == df.columns and collections.Counter(r["_bad"] for r in out.collect()) == collections.Counter(range(len(rows)))
    assert stage["sentencepiece"](spark, df, SF_SMALL).count() == len(rows)


def test_every_operator_has_its_query():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(x for x in queries.QUERIES))
def test_schemas(spark, name):
    """The contract's columns, in their types."""
    want = {
        "op1": "doc_id bigint, held_out boolean, lang_pred string, score double",
        "op2": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
               "base_failed boolean, kept boolean",
        "op6": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
        "op8": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
        "op9": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
        "op10": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
        "op11": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
        "op12": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
        "op13": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"}.get(name.split("_")[0])
    if want:
        df = queries.QUERIES[name](spark, SF_SMALL)
        assert ", ".join(f"{a} {b}" for a, b in df.dtypes) == want
