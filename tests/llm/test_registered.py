"""The registered queries against their SQL, or against brute force, on the smallest tables."""

import hashlib
import re
import zlib
from fractions import Fraction
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from brute import collapsed, components_by_sets, pii_spans, runs_by_periods, squeezed
from kudosflow.llm import registry
from tokenizers import Tokenizer

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def answer(spark):
    """The rows of a registered query, run once."""
    known = {}

    def rows(name):
        if name not in known:
            known[name] = registry.queries()[name](spark, str(FOLDER)).toPandas()
        return known[name]

    return rows


@pytest.fixture(scope="module")
def documents():
    found = duckdb.sql(f"SELECT doc_id, text, lang FROM '{FOLDER}/documents.parquet'").df()
    return found.set_index("doc_id").sort_index()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_the_driver_sees_every_query():
    assert registry.queries().items() <= driver.queries().items()
    assert registry.oracle_sql().items() <= driver.oracle_sql().items()
    numbers = [int(m[1]) for name in registry.queries() if (m := re.match(r"op(\d+)_", name))]
    assert sorted(numbers) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(name, answer):
    with duckdb.connect() as duck:
        for file in FOLDER.glob("*.parquet"):
            duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        wanted = duck.execute(registry.oracle_sql()[name]).df()
    ours = answer(name)
    columns = sorted(ours.columns)
    assert columns == sorted(wanted.columns)
    rows = []
    for df in (ours[columns], wanted[columns]):
        rows.append(sorted(map(repr, df.astype(object).where(df.notna(), None).values.tolist())))
    assert rows[0] == rows[1]


def test_decontamination_finds_each_whole_item(answer, documents):
    items = duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    wanted = {
        (number, item)
        for number, text in documents.text.items()
        for item, passage in items
        if squeezed(passage) in squeezed(text)
    }
    found = answer("op2_decontaminate")
    assert wanted
    assert set(zip(found.doc_id, found.item_id)) == wanted


def test_resampling_keeps_its_share_and_leaves_the_worst(answer, documents):
    found = answer("op3_importance_resampling")
    labels = duckdb.sql(f"SELECT quality FROM '{FOLDER}/labels.parquet'").df().quality
    assert len(found) == len(documents)
    assert found.kept.sum() == round(min(1.0, labels.mean() + 0.02) * len(found))
    assert found[found.kept].score.min() >= found[~found.kept].score.max() - 1e-4


def test_near_duplicates_are_the_components_of_all_pairs(answer, documents):
    wanted = components_by_sets(documents.text.to_dict(), 4, 80)
    found = answer("op4_near_duplicates").set_index("doc_id")
    assert found.component_id.to_dict() == wanted
    assert (found.kept == (found.index == found.component_id)).all()


def test_personal_data_is_what_the_plain_patterns_find(answer, documents):
    found = answer("op5_pii").set_index("doc_id")
    for number, text in documents.text.items():
        spans = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in pii_spans(text))
        assert found.base_sha256[number] == hashlib.sha256(spans.encode()).hexdigest()


def test_shards_are_even_whole_and_numbered(answer, documents):
    found = answer("op6_sharding").set_index("doc_id")
    raw = documents.text.map(str.encode)
    assert found["size"].to_dict() == (raw.map(len) + 1).to_dict()
    assert found.text_crc32.to_dict() == raw.map(zlib.crc32).to_dict()
    for _, shard in found.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    # Links between equal texts: few are cut, for even sizes in so small a table; by the
    # rest of the id most would be.
    groups = found.assign(text=documents.text, start=found.index % 8).groupby("text")
    cut, by_id = (int((groups[name].nunique() - 1).sum()) for name in ("shard", "start"))
    assert 4 * cut <= by_id
    sizes = found.groupby("shard")["size"].sum()
    assert len(sizes) == 8
    assert sizes.max() - sizes.min() < 0.1 * sizes.mean()


def test_packing_holds_all_tokens_in_few_sequences(answer, documents, tokenizer):
    found = answer("op7_best_fit_packing").sort_values(["doc_id", "piece"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    wanted = []
    for number, text in documents.text.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            wanted.append((number, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert list(found[columns].itertuples(index=False, name=None)) == wanted
    _gapless(found)


def _gapless(found):
    placed = found.sort_values(["sequence_id", "offset"])
    ends = placed.groupby("sequence_id").length.cumsum()
    assert (ends - placed.length == placed.offset).all()
    assert ends.max() <= 2048
    # Within two sequences, or 3 %, of what all tokens need.
    least = -(-placed.length.sum() // 2048)
    assert placed.sequence_id.nunique() <= max(least + 2, 1.03 * least)


def test_token_files_give_back_every_id(answer, documents, tokenizer):
    found, before = answer("op8_token_files").set_index("doc_id"), 0
    assert len(found) == len(documents)
    for number, text in documents.text.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        row = (before, len(ids), zlib.crc32(ids.tobytes()))
        assert tuple(found.loc[number, ["start", "n_tokens", "ids_crc32"]]) == row
        before += len(ids)


def test_languages_of_held_out_documents(answer, documents):
    found = answer("op9_language_id").set_index("doc_id").sort_index()
    assert (found.held_out == [zlib.crc32(str(x).encode()) % 4 == 2 for x in found.index]).all()
    assert found.score.between(0, 1).all()
    own = found.held_out
    assert (found.lang_pred == documents.lang)[own].mean() >= 0.98


def test_periodic_runs_are_those_of_all_periods(answer, documents):
    found = answer("op11_periodic_runs").set_index("doc_id")
    assert len(found) == len(documents)
    for number, text in documents.text.items():
        words, drawn = text.encode().split(), zlib.crc32(str(number).encode())
        if drawn % 10 == 0 and words:
            a, n = drawn // 10 % len(words), len(words)
            p = 1 + (n - a) // (3 + drawn // 10 % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = runs_by_periods(words, 24)
        row = found.loc[number]
        assert row.n_runs == len(runs)
        lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, runs)).hexdigest()
        if runs:
            most = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
            assert (row.start, row.length, row.period) == most
            assert row.exponent_milli == 1000 * most[1] // most[2]
        else:
            assert row[["start", "length", "period", "exponent_milli"]].isna().all()
    assert found.n_runs.max() > 0


def test_pipeline_against_brute_force(answer, spark, documents, tokenizer):
    """Stage by stage over plain Python, on what the learned first stage keeps."""
    assert corpus_pipeline.ORACLE_SQL is None
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "language_id"
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = corpus_pipeline.identify_languages(spark, docs, str(FOLDER))
    assert kept.columns == docs.columns
    texts = {row.doc_id: row.text for row in kept.select("doc_id", "text").collect()}
    assert set(documents.index) - set(texts) == {
        number for number, text in documents.text.items() if not any(map(str.isalpha, text))
    }
    groups = components_by_sets(texts, 5, 80)
    items = duckdb.sql(f"SELECT text FROM '{FOLDER}/benchmark.parquet'").df().text
    wanted = {}
    for number, text in texts.items():
        if groups[number] != number:
            continue
        if any(squeezed(item) in squeezed(text) for item in items):
            continue
        done = 0
        clean = ""
        for start, _, end, kind in pii_spans(text):
            if start >= done:
                clean += f"{text[done:start]}<{kind.upper()}>"
            done = max(done, end)
        ids = [*tokenizer.encode(clean + text[done:], add_special_tokens=False).ids, 0]
        wanted[number] = zlib.crc32(np.array(ids[:2048], "<u4").tobytes())
    found = answer("pipeline")
    first = found[found.piece == 0].set_index("doc_id").ids_crc32.to_dict()
    assert first == wanted
    _gapless(found)


