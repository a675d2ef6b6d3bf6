"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import tracemalloc

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from brute import components_by_sets
from kudosflow.llm import (
    best_fit_packing,
    decontaminate,
    importance_resampling,
    language_id,
    near_duplicates,
    pii,
    quality_rules,
    sharding,
    token_files,
    tokens,
    url_rules,
)
from kudosflow.llm.common import cutoffs, running_sum
from kudosflow.llm.components import components
from kudosflow.llm.tokens import Encoder, read_tokenizer
from kudosflow.session import scratch_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

WORDS = "the of and to house river garden light stone paper window people water north".split()
RNG = np.random.default_rng(3)
LONG = " ".join(RNG.choice(WORDS, 60_000))
PROSE = " ".join(RNG.choice(WORDS, 80)) + "."
PASSAGE = (
    "a quiet river runs beside the old stone house where nobody has lived for a hundred years now"
)
#: A number that pandas cannot hold beside a null.
BIG = 2**62 + 1
CLASHING = "kept string, score string, lang_pred string, rejected int, host int, rank int, bin int"
SCHEMA = f"doc_id bigint, text string, lang string, {CLASHING}, `odd name.` double"
ROWS = [
    (1, PROSE, "en"),
    (1, PROSE, "en"),
    (2, PROSE, None),
    (3, None, "en"),
    (4, "", "fr"),
    (5, " \n\t ", None),
    (None, PROSE, "en"),
    (6, LONG, "en"),
    (7, "...", "en"),
    (8, "one", None),
    (9, f"{PROSE} {PASSAGE} {PROSE}", "en"),
    (BIG, "mail me@example.org or call +1 (415) 555-0100", "en"),
]
EXTRA = ("x", None, "y", 1, 2, None, 3, float("nan"))
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*row, *EXTRA) for row in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, PASSAGE), (2, None), (None, PASSAGE), (3, ""), (4, "too short"), (1, PASSAGE)]
    return spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.fixture(scope="module")
def tokenizer():
    return read_tokenizer(TOKENIZER)


def by_id(df, *columns):
    return sorted(df.select("doc_id", *columns).collect(), key=lambda row: (row[0] is None, row))


def test_quality_rules(odd, nothing):
    found = quality_rules.quality_rules(odd)
    rows = {row.doc_id: row for row in found.collect()}
    assert found.count() == len(ROWS)
    assert rows[3].n_words == rows[4].n_words == rows[5].n_words == 0
    assert all(rows[number].base_failed and not rows[number].kept for number in (3, 4, 5, 7, 8))
    assert rows[6].n_words == 60_000
    assert rows[6].base_failed  # few words make the same windows again and again
    assert rows[1].kept and rows[None].kept
    assert rows[1]["odd name."] != rows[1]["odd name."]
    assert quality_rules.quality_rules(nothing).collect() == []


def test_texts_of_other_languages_pass_without_the_stop_word_rule(spark):
    words = "talo joki puutarha valo kivi paperi ikkuna ihmiset vesi pohjoinen kirja tie".split()
    df = spark.createDataFrame([(" ".join(RNG.choice(words, 80)),)], "text string")
    row = quality_rules.quality_rules(df).first()
    assert (row.base_failed, row.failed_rules, row.kept) == (False, ["stop_words"], False)
    rest = [rule for rule in quality_rules.RULES if rule.name != "stop_words"]
    assert quality_rules.quality_rules(df, rules=rest).first().kept


def test_quality_counts_by_hand(spark):
    text = "a b c a b c\n- x…\n\n- x…\n#|é"
    row = quality_rules.text_counts(spark.createDataFrame([(text,)], "text string")).first()
    assert (row.n_words, row.word_chars, row.n_symbols) == (11, 15, 2)
    assert (row.n_lines, row.n_dup_lines) == (4, 1)
    assert (row.n_bullet_lines, row.n_ellipsis_lines) == (2, 2)
    # "a b c" stands at 0 and 3; no other window comes twice.
    assert row.n_repeat_words == 6


def test_decontamination(odd, nothing, benchmark):
    found = decontaminate.contaminations(odd, benchmark)
    assert [(row.doc_id, row.item_id, row.edits) for row in found.collect()] == [(9, 1, 0)]
    kept = decontaminate.decontaminate(odd, benchmark)
    assert kept.columns == odd.columns
    assert kept.count() == len(ROWS) - 1
    assert decontaminate.contaminations(nothing, benchmark).collect() == []
    assert decontaminate.contaminations(odd, benchmark.limit(0)).collect() == []


def test_decontamination_in_blocks_and_with_edits(spark, benchmark):
    edited = PASSAGE.replace("quiet", "quite").replace("stone", "st0ne")
    docs = spark.createDataFrame(
        [(1, f"{PROSE}\n{edited.upper()} {PROSE}"), (2, PROSE), (3, PASSAGE[:50])],
        "doc_id bigint, text string",
    )
    small = decontaminate.Bounds(block_chars=10)
    found = decontaminate.contaminations(docs, benchmark, bounds=small).collect()
    assert [(row.doc_id, row.item_id) for row in found] == [(1, 1)]
    assert 0 < found[0].edits <= 5


def test_every_stretch_within_the_edits_is_found():
    """The lemma against the plain edit distance, on random edits of a window."""
    bounds = decontaminate.Bounds(window=60, edits=3, q=4, shortest=30)
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefgh"))
    for _ in range(60):
        item = "".join(rng.choice(letters, 60))
        edited = list(item)
        for _ in range(3):
            at = int(rng.integers(len(edited)))
            match rng.integers(3):
                case 0:
                    edited[at] = "x"
                case 1:
                    del edited[at]
                case _:
                    edited.insert(at, "y")
        around = ["".join(rng.choice(letters, 40)) for _ in range(2)]
        found = decontaminate.Benchmark([(7, item)], bounds).matches("".join(edited).join(around))
        assert [one[0] for one in found] == [0]
        assert found[0][3] <= 3


def test_short_items_are_found_as_they_are():
    items = ["too short", "short", "Yes!", "the river", "漢字", "", "...", "x 1"]
    index = decontaminate.Benchmark(list(enumerate(items, 1)), decontaminate.Bounds())

    def found(text):
        signs = decontaminate.normalised(text, index.counts)
        rows = index.matches(text)
        for item, start, end, edits in rows:
            wanted = decontaminate.normalised(items[index.items[item] - 1], index.counts)
            assert (signs[start:end].tolist(), edits) == (wanted.tolist(), 0)
        return sorted(index.items[row[0]] for row in rows)

    assert found("It is -- TOO\nSHORT, yes. Too short") == [1, 2, 3]
    assert found("toos hort, yesterday, the rivers") == []
    assert found("x; 1 the") == [8]
    assert found("仮漢字文") == [5]
    assert found("breathe river the river") == [4]
    assert found(None) == found("") == []


def edits_of_a_stretch(pattern, text):
    """Fewest edits that turn the pattern into some stretch of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, sign in enumerate(pattern, 1):
        last, row = row, [i]
        for j, other in enumerate(text):
            row.append(min(last[j] + (sign != other), last[j + 1] + 1, row[j] + 1))
    return min(row)


@pytest.mark.parametrize("edits", [4, 5])
def test_every_window_cut_from_a_longer_item_is_found(edits):
    bounds = decontaminate.Bounds()
    rng = np.random.default_rng(edits)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    item = "".join(rng.choice(letters, 240))
    index = decontaminate.Benchmark([(7, item)], bounds)
    for turn in range(60):
        start = int(rng.integers(len(item) - bounds.window + 1))
        edited = list(item[start : start + bounds.window])
        for _ in range(edits):
            at = int(rng.integers(len(edited)))
            match rng.integers(3) if turn % 2 else 0:
                case 0:
                    edited[at] = "1"
                case 1:
                    del edited[at]
                case _:
                    edited.insert(at, "2")
        doc = "3" * 50 + "".join(edited) + "4" * 50
        found = index.matches(doc)
        assert [one[0] for one in found] == [0]
        assert found[0][3] <= edits
        if turn < 4:
            near = range(max(0, start - 5), min(len(item) - bounds.window, start + 5) + 1)
            cuts = [item[s : s + bounds.window] for s in near]
            assert found[0][3] == min(edits_of_a_stretch(cut, doc) for cut in cuts)


def test_resampling(spark, odd, nothing):
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (7, 0), (7, 0), (None, 1), (8, None)], "doc_id bigint, quality int"
    )
    found = importance_resampling.resample(odd.select("doc_id", "text"), labels, share=0.5)
    rows = {row.doc_id: row for row in found.collect()}
    assert set(rows) == {row[0] for row in ROWS}
    assert found.count() == len(ROWS)
    assert rows[3].log_ratio == rows[4].log_ratio == 0
    assert found.where("kept").count() <= len(ROWS) // 2
    again = importance_resampling.resample(odd.select("doc_id", "text"), labels, share=0.5)
    assert sorted(found.collect(), key=repr) == sorted(again.collect(), key=repr)
    no_labels = importance_resampling.resample(odd.select("doc_id", "text"), labels.limit(0))
    assert no_labels.where("kept").count() == len(ROWS)
    assert importance_resampling.resample(nothing.select("doc_id", "text"), labels).collect() == []


def test_near_duplicates(odd, nothing):
    found = by_id(near_duplicates.near_duplicates(odd), "n_shingles", "component_id", "kept")
    assert len(found) == len(ROWS)
    rows = {row.doc_id: row for row in found}
    assert rows[2].component_id == 1 and not rows[2].kept
    assert [row.kept for row in found if row.doc_id == 1] == [True, True]
    assert (rows[None].component_id, rows[None].kept) == (None, True)
    for number in (3, 4, 5):
        assert (rows[number].n_shingles, rows[number].component_id) == (0, number)
    assert rows[7].n_shingles == rows[8].n_shingles == 1
    assert set(rows) == {row[0] for row in ROWS}
    assert near_duplicates.near_duplicates(nothing).collect() == []


def test_an_id_with_several_texts_joins_their_groups(spark):
    texts = [" ".join(RNG.choice(WORDS, 60)) for _ in range(3)]
    rows = [(5, texts[0]), (5, texts[1]), (2, texts[0]), (3, texts[1]), (4, texts[2])]
    found = near_duplicates.near_duplicates(
        spark.createDataFrame(rows, "doc_id bigint, text string")
    )
    assert {(row.doc_id, row.component_id) for row in found.collect()} == {
        (5, 2), (2, 2), (3, 2), (4, 4)
    }


def test_near_duplicates_of_chains_and_templates(spark):
    """Groups whose members are near but not all linked, in blocks of few rows."""
    rng = np.random.default_rng(8)
    texts, number = {}, 0
    for _ in range(6):
        base = rng.choice(WORDS, 90)
        for _ in range(30):
            changed = base.copy()
            for at in rng.integers(0, 90, rng.integers(0, 7)):
                changed[at] = f"w{rng.integers(10_000)}"
            texts[number], number = " ".join(changed), number + 1
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    wanted = components_by_sets(texts, 4, 80)
    for block, often in ((4, 2), (4, 5), (1024, 64)):
        scheme = near_duplicates.Scheme(words=4, block=block, often=often)
        found = near_duplicates.near_duplicates(df, scheme=scheme).collect()
        assert {row.doc_id: row.component_id for row in found} == wanted


def test_signatures_within_the_threshold_share_a_key(spark):
    scheme = near_duplicates.Scheme()
    rng = np.random.default_rng(2)
    rows = []
    for number in range(40):
        one = rng.integers(-30_000, 30_000, scheme.chunks * scheme.width)
        two = one.copy()
        wrong = rng.permutation(len(one))[: scheme.chunks * (scheme.errors + 1) - 1]
        two[wrong] += 1
        rows.append((number, one.tolist(), two.tolist()))
    df = spark.createDataFrame(rows, "n int, one array<smallint>, two array<smallint>")
    one, two = (near_duplicates.keys(F.col(name), scheme) for name in ("one", "two"))
    assert df.where(F.arrays_overlap(one, two)).count() == len(rows)


def test_components_of_a_long_chain(spark):
    rows = [(i, i + 1) for i in range(200)] + [(500, 900), (900, 700), (700, 700), (None, 1)]
    found = components(spark.createDataFrame(rows, "a bigint, b bigint"))
    wanted = {i: 0 for i in range(201)} | {500: 500, 900: 500, 700: 500}
    assert {row.id: row.component for row in found.collect()} == wanted
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_pii(spark, odd, nothing):
    found = pii.find_pii(odd.withColumn("pii_spans", F.lit("old")))
    rows = {row.doc_id: row for row in found.collect()}
    assert rows[3].pii_spans == rows[4].pii_spans == []
    assert [(s.kind, s.start, s.end) for s in rows[BIG].pii_spans] == [
        ("email", 5, 19),
        ("phone", 28, 45),
    ]
    assert pii.find_pii(nothing).collect() == []


def test_pii_kinds_and_redaction(spark):
    texts = {
        "IBAN DE89 3704 0044 0532 0130 00 is paid": "IBAN <IBAN> is paid",
        "DE89 3704 0044 0532 0130 01 is not one": "DE89 3704 0044 0532 0130 01 is not one",
        "my ssn is 123-45-6789.": "my ssn is <NATIONAL_ID>.",
        "part no 123-45-6789.": "part no 123-45-6789.",
        "é 4111 1111 1111 1111 é": "é <CARD> é",
        "a@b.co_d@e.f x": "<EMAIL><EMAIL> x",
        "1.2.3.4.5.6.7.8 and 256.1.1.1": "<IP>.<IP> and 256.1.1.1",
        "x" * 3000 + " me@example.org": "x" * 3000 + " <EMAIL>",
    }
    df = pii.find_pii(spark.createDataFrame([(text,) for text in texts], "text string"))
    done = df.select("text", pii.redact(F.col("text"), F.col("pii_spans")).alias("out")).collect()
    assert {row.text: row.out for row in done} == texts


def test_account_numbers_beside_other_capitals_and_digits(spark):
    spanish, belgian = "ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034"
    texts = {
        f"{spanish} IS it": "<IBAN> IS it",
        f"{spanish} 2024 and": "<IBAN> 2024 and",
        f"{belgian} PAID NOW": "<IBAN> PAID NOW",
        f"{belgian} {spanish} {belgian}": "<IBAN> <IBAN> <IBAN>",
        f"AB12 CODE {spanish} OK": "AB12 CODE <IBAN> OK",
        "BE68539007547034 NOW": "<IBAN> NOW",
        f"{belgian}A NOW": f"{belgian}A NOW",
        f"{belgian[:-1]}5 IS": f"{belgian[:-1]}5 IS",
    }
    df = pii.find_pii(spark.createDataFrame([(text,) for text in texts], "text string"))
    done = df.select("text", pii.redact(F.col("text"), F.col("pii_spans")).alias("out")).collect()
    assert {row.text: row.out for row in done} == texts


def test_long_runs_cost_no_more_than_their_length(spark):
    """Patterns that tried every start of a run would take minutes here."""
    text = "a" * 300_000 + " " + "1" * 300_000 + " " + "1.2.3.4 " * 3_000 + "+" * 20_000
    df = spark.createDataFrame([(text,)], "text string")
    found = pii.find_pii(df).select(F.size("pii_spans").alias("n")).first().n
    assert found == 3_000


def test_shards(odd, nothing):
    found = sharding.shard_documents(odd, 3).collect()
    assert len(found) == len(ROWS)
    assert {row.doc_id for row in found} == {row[0] for row in ROWS}
    by_shard = {}
    for row in found:
        by_shard.setdefault(row.shard, []).append(row.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert {row["size"] for row in found if row.doc_id in (3, 4)} == {1}
    assert sharding.shard_documents(nothing).collect() == []
    one = sharding.shard_documents(odd, 1).collect()
    assert sorted(row.slot for row in one) == list(range(len(ROWS)))


def test_a_group_larger_than_a_shard_fills_several(spark):
    rows = [(i, "same text " * 5) for i in range(900)]
    rows += [(1000 + i, f"{i} " * 20) for i in range(900)]
    found = sharding.shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string"))
    sizes = found.groupBy("shard").agg(F.sum("size").alias("n")).toPandas().n
    assert len(sizes) == 8
    assert sizes.max() <= 1.05 * sizes.mean()


def test_packing(odd, nothing, tokenizer):
    packed = best_fit_packing.pack_documents(odd, tokenizer, 64, ids=True)
    rows = packed.collect()
    assert sum(row.doc_id == 1 for row in rows) == 2 * sum(row.doc_id == 2 for row in rows)
    assert [row.length for row in rows if row.doc_id == 3] == [1]
    assert {row.doc_id for row in rows} == {row[0] for row in ROWS}
    whole = {row.sequence_id: row.ids for row in best_fit_packing.sequences(packed).collect()}
    for row in rows:
        part = bytes(whole[row.sequence_id][4 * row.offset : 4 * (row.offset + row.length)])
        assert part == bytes(row.ids)
    assert max(map(len, whole.values())) <= 4 * 64
    assert best_fit_packing.pack_documents(nothing, tokenizer).collect() == []


@pytest.mark.parametrize("short", [1, 6, 100])
@pytest.mark.parametrize("groups", [1, 3, 50])
def test_packer_places_each_piece_once(groups, short):
    rng = np.random.default_rng(4)
    for _ in range(20):
        lengths = rng.integers(1, 101, rng.integers(1, 300))
        counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
        packer = best_fit_packing.Packer(counts, 100, groups, short)
        places = {}
        sequence = 0
        for run in packer.runs:
            offset = 0
            for length, rank in run.contents:
                for i in range(run.n):
                    assert places.setdefault((length, rank + i), (sequence + i, offset))
                offset += length
            assert offset <= 100
            sequence += run.n
        assert len(places) == len(lengths)
        assert all(rank < counts[length] for length, rank in places)
        if short == 6 and groups == 50:
            assert sequence <= 1.25 * -(-lengths.sum() // 100) + 2


def test_token_files(spark, odd, nothing, tokenizer):
    path = scratch_path(spark, "t")
    token_files.write_token_files(odd, path, tokenizer)
    rows = token_files.read_token_files(spark, path, ids=True).collect()
    assert len(rows) == len(ROWS)
    rows.sort(key=lambda row: row.start)
    assert {row.doc_id for row in rows} == {row[0] for row in ROWS}
    ids = [row.doc_id for row in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    before = [sum(row.n_tokens for row in rows[:i]) for i in range(len(rows))]
    assert [row.start for row in rows] == before
    plain = Tokenizer.from_str(tokenizer)
    for row in rows:
        texts = [text or "" for number, text, _ in ROWS if number == row.doc_id]
        wanted = [[*plain.encode(text, add_special_tokens=False).ids, 1] for text in texts]
        assert np.frombuffer(row.ids, "<u4").tolist() in wanted
    empty = scratch_path(spark, "t")
    token_files.write_token_files(nothing, empty, tokenizer)
    assert token_files.read_token_files(spark, empty).collect() == []


def test_a_damaged_block_is_refused():
    ids = [np.arange(5, dtype="<u4"), np.array([3], "<u4")]
    block = token_files.pack_block([7, None], ids, 9)
    owners, found = token_files.unpack_block(block)
    assert owners == [7, None]
    assert [one.tolist() for one in found] == [one.tolist() for one in ids]
    for at in (2, 30, len(block) - 1):
        damaged = bytearray(block)
        damaged[at] ^= 1
        with pytest.raises(ValueError):
            token_files.unpack_block(bytes(damaged))
    with pytest.raises(ValueError):
        token_files.unpack_block(block[:20])


def test_words_one_by_one_give_the_ids_of_the_text(tokenizer):
    plain, encoder = Tokenizer.from_str(tokenizer), Encoder(tokenizer)
    assert encoder.by_word
    texts = [
        "", " ", "It's the DON'T, x'll!!! a\u00a0b\u2003c 'S", "<|endoftext|> <|ENDOFTEXT|>a<|startoftext|>",
        "e\u0301É ＡＢ Straße ΣΑΣ İ 1234 3.14%", "a!\u0338b \u0301 a.\u0301b", "emoji 👩‍👩‍👧 漢字かな", "x\x1cy\x85z\u200bq",
        *(text or "" for _, text, _ in ROWS),
    ]
    wanted = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)] == wanted


def test_texts_cut_at_white_space_give_the_same_ids(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 7)
    plain, encoder = Tokenizer.from_str(tokenizer), Encoder(tokenizer)
    texts = ["", " \t ", None, "a  \n b!c", PASSAGE, "É́ ＡＢ\u00a0Straße \u0301 x", "<|endoftext|> a", "x" * 40, "ab"]
    wanted = [plain.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)] == wanted


def test_the_ids_that_an_encoder_keeps_have_a_bound(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "MOST_IDS", 60)
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 100)
    plain, encoder = Tokenizer.from_str(tokenizer), Encoder(tokenizer)
    texts = [" ".join(f"{word}{n}" for word in WORDS) for n in range(12)] + ["z9" * 300]
    wanted = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    for _ in range(2):  # words that are kept and words that are not
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)] == wanted
    assert 0 < encoder.pooled <= 60


def test_memory_of_an_encoder_does_not_grow_with_the_texts(tokenizer):
    encoder, text = Encoder(tokenizer), LONG[:100_000]
    encoder.ids([text])

    def taken(texts):
        tracemalloc.start()
        found = encoder.ids(texts)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return (peak - sum(map(len, found))) / 2**20

    assert taken([text] * 40) < 40  # 4 MB of texts, and the same of one text
    assert taken([" ".join([text] * 40)]) < 40


def test_languages(spark, odd, nothing):
    labelled = spark.createDataFrame(
        [
            (1, "the house and the river and the light of the north", "en"),
            (2, "la maison et le fleuve et la lumière du nord", "fr"),
            (3, None, "en"),
            (4, "...", "fr"),
            (5, "the garden", None),
        ],
        "doc_id bigint, text string, lang string",
    )
    model = language_id.fit_languages(labelled)
    assert set(model.names) == {"en", "fr"}
    found = language_id.identify(odd, model)
    assert found.columns[: len(odd.columns)] == odd.columns
    lang, score, rejected = found.columns[-3:]
    rows = {row.doc_id: row for row in found.collect()}
    for number in (3, 4, 5, 7):
        assert (rows[number][lang], rows[number][score], rows[number][rejected]) == ("und", 0, True)
    assert (rows[1][lang], rows[1]["lang_pred"], rows[1]["kept"]) == ("en", "y", "x")
    assert rows[BIG].doc_id == BIG
    far = spark.createDataFrame([("漢字仮名交じり文 " * 40,)], "text string")
    assert language_id.identify(far, model).first().rejected
    unknown = language_id.identify(odd, language_id.fit_languages(labelled.limit(0)))
    assert {row[lang] for row in unknown.collect()} == {"und"}
    assert language_id.identify(nothing, model).collect() == []


def test_texts_longer_than_all_labelled_ones_are_judged_as_the_longest(spark):
    words = {"en": WORDS, "fr": "le la et de maison rivière jardin lumière pierre eau nord".split()}
    rows = [
        (n, " ".join(RNG.choice(own, 60)), lang)
        for lang, own in words.items()
        for n in range(20)
    ]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit_languages(labelled)
    seen = max(language_id.length_class(language_id.ngram_counts(text)[1]) for _, text, _ in rows)
    assert (model.least[seen + 1 :] == model.least[seen]).all()
    assert 0 < model.least[seen] <= 0.5
    texts = [" ".join(RNG.choice(words["fr"], 60 * 4**n)) for n in range(6)]
    far = "漢字仮名交じり文 " * 60_000
    df = spark.createDataFrame([(text,) for text in (*texts, LONG, far)], "text string")
    found = language_id.identify(df, model).collect()
    assert [row.lang_pred for row in found[:-1]] == ["fr"] * 6 + ["en"]
    assert [row.rejected for row in found] == [False] * 7 + [True]


def test_urls(spark):
    urls = {
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "no host": ("", "", None, "allow"),
        "http://NET/": ("net", "/", "net/", "block"),
        "http://a.net": ("a.net", "", None, "allow"),
        "http://a.net?x=/": ("a.net", "", None, "allow"),
        "http://example.net/en/1#a": ("example.net", "/en/1", "example.net/en/", "allow"),
        "x://b.example.net/en": ("b.example.net", "/en", "net/", "block"),
        "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "http://m.example.com/de/a?b": ("m.example.com", "/de/a", "example.com/de/", "block"),
        "http://x.org/fr/://y": ("x.org", "/fr/://y", "org/fr/", "allow"),
        "http://É.NET/": ("É.net", "/", "net/", "block"),
    }
    rows = [(url, 1, "old") for url in urls]
    df = spark.createDataFrame(rows, "url string, path int, Host string")
    found = url_rules.filter_urls(df, url_rules.PAGE_RULES)
    assert found.columns[:3] == df.columns
    assert {row.url: tuple(row)[3:] for row in found.collect()} == urls
    assert url_rules.filter_urls(df.limit(0), url_rules.PAGE_RULES).collect() == []
    none = url_rules.filter_urls(df, [], default="block")
    assert {row[-1] for row in none.collect()} == {"block"}


def test_longest_rule_wins_and_partial_segments_match():
    rule = url_rules.UrlRule
    trie = url_rules.UrlTrie(
        [rule("block", "com"), rule("allow", "a.com"), rule("block", "a.com", "/pri"),
         rule("allow", "a.com", "/private/x/"), rule("allow", "b.com", "/"), rule("block", "b.com", "/")]
    )
    assert trie.find("z.com", "") == ("block", "com")
    assert trie.find("q.a.com", "/") == ("allow", "a.com")
    assert trie.find("a.com", "/private/y") == ("block", "a.com/pri")
    assert trie.find("a.com", "/private/x/1") == ("allow", "a.com/private/x/")
    assert trie.find("b.com", "/1") == ("block", "b.com/")
    assert trie.find("com.", "/") is None
    with pytest.raises(ValueError):
        url_rules.UrlTrie([rule("maybe", "com")])


def test_every_stage_on_odd_and_on_no_documents(spark, odd, nothing, benchmark, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for df in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, df, str(tmp_path))
            assert kept.columns == df.columns
            assert kept.count() <= df.count()
    language, near, passages, personal, packing = (stage for _, stage in corpus_pipeline.STAGES)
    left = {row.doc_id for row in language(spark, odd, str(tmp_path)).collect()}
    assert left == {1, 2, None, 6, 8, 9, BIG}
    assert {row.doc_id for row in near(spark, odd, str(tmp_path)).collect()} == {
        row[0] for row in ROWS
    } - {2}
    texts = {row.doc_id: row.text for row in personal(spark, odd, str(tmp_path)).collect()}
    assert texts[3] is None
    assert texts[BIG] == "mail <EMAIL> or call <PHONE>"
    assert packing(spark, nothing, str(tmp_path)).collect() == []


def test_running_sums_over_blocks(spark):
    for n in (0, 1, 255, 256, 257, 1000):
        numbers = F.sequence(F.lit(1), F.lit(n)) if n else F.array().cast("array<int>")
        found = spark.range(1).select(running_sum(numbers, 16)).first()[0]
        assert found == np.cumsum(np.arange(1, n + 1)).tolist()


def test_cutoffs_take_what_fits(spark):
    rng = np.random.default_rng(6)
    rows = [(int(g), int(p), int(w)) for g, p, w in zip(
        rng.integers(0, 3, 500), rng.integers(0, 1 << 20, 500), rng.integers(1, 9, 500))]
    df = spark.createDataFrame(rows, "g int, p bigint, w bigint")
    quotas = [(0, 100), (1, 0), (2, 10**9), (0, 300)]
    cuts = cutoffs(df, F.col("g"), F.col("p"), F.col("w"), quotas, 20)
    for (group, quota), cut in zip(quotas, cuts):
        own = sorted((p, w) for g, p, w in rows if g == group)
        taken = sum(w for p, w in own if p < cut)
        assert taken <= quota
        following = [w for p, w in own if p == cut]
        assert not following or taken + sum(following) > quota
