"""The pipeline, each stage on its own input against a plain version."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_dedup import LOWER, components_by_force, print_by_force

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEY = "AKIA" + "Z9Q8" * 4
SECRETS = (
    re.compile(r"""(?:[Pp]assword|[Tt]oken)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8,}"""),
    re.compile(r"AKIA[A-Z0-9]{12,}"),
    re.compile(r"[0-9a-f]{32,}"),
)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after every stage, from documents with copies, secrets and odd rows."""
    root = tmp_path_factory.mktemp("pipeline")
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*COLUMNS).collect()]
    made = list(docs)
    for i, (_, text, lang, source, _) in enumerate(docs[:20]):
        for k, changed in enumerate((text.swapcase(), text + " more", f"{text} key {KEY} token: abcd{i}efgh", text)):
            made.append((10_000 + 10 * i + k, changed, lang, source, len(changed)))
    long = docs[0][1] + " " + " ".join(t for _, t, *_ in docs[:60])
    made += [(20_000, None, None, None, None), (20_001, "", "en", None, 0), (None, docs[1][1], "en", "s", 5), (20_002, long, "en", "s", len(long)), (20_002, long, "en", "s", len(long))]
    spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{root}/labels.parquet")
    found, frame = [made], spark.read.parquet(f"{root}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{root}/stage{number}"
        stage(spark, frame, str(root)).write.parquet(path)
        frame = spark.read.parquet(path)
        if number < 4:
            assert frame.columns == COLUMNS
        found.append([tuple(r) for r in frame.collect()])
    return found, frame.columns, str(root)


def test_quality_drops_only_rejected_rows(stages):
    (before, after, *_), _, _ = stages
    assert not Counter(after) - Counter(before) and len(after) > len(before) / 3


def test_exact_keeps_the_largest_id(stages):
    (_, before, after, *_), _, _ = stages
    groups = defaultdict(list)
    for row in before:
        groups[(row[1] or "").translate(LOWER)].append(row)
    want = {text: max((r[0] for r in rows if r[0] is not None), default=None) for text, rows in groups.items()}
    assert {(r[1] or "").translate(LOWER): r[0] for r in after} == want and len(after) == len(want)
    assert not Counter(after) - Counter(before)


def test_near_keeps_one_of_every_component(stages):
    (_, _, before, after, *_), _, _ = stages
    kept = components_by_force([print_by_force(r[1]) for r in before], [r[0] for r in before])
    assert sorted(r[0] for r in after if r[0] is not None) == sorted({k for k in kept if k is not None})
    assert not Counter(after) - Counter(before) and len(after) < len(before)


def test_secrets_masks_texts_and_keeps_rows(stages):
    (_, _, _, before, after, _), _, _ = stages
    assert sorted(map(str, (r[0] for r in before))) == sorted(map(str, (r[0] for r in after)))
    old = {r[0]: r for r in before}
    for row in after:
        assert not row[1] or not any(p.search(row[1]) for p in SECRETS)
        assert row[2:4] == old[row[0]][2:4] and (row[1] == old[row[0]][1] or (row[4] == len(row[1]) and "[secret]" in row[1]))


def test_packing_holds_every_token_once(stages):
    (*_, before, pieces), columns, _ = stages
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [dict(zip(columns, p, strict=True)) for p in pieces]
    total = Counter()
    for r in rows:
        total[r["doc_id"]] += r["length"]
    assert total == {r[0]: len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in before}
    ends = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 1024


def test_run_leaves_its_last_result(spark, stages):
    found, columns, root = stages
    again = corpus_pipeline.run(spark, root)
    place = columns.index("length")
    assert again.columns == columns and Counter(tuple(r)[: place + 1] for r in again.select(*columns).collect()) == Counter(p[: place + 1] for p in found[-1])


def test_stages_of_nothing(spark, stages, tmp_path):
    _, _, root = stages
    frame = spark.read.parquet(f"{root}/documents.parquet").where("false")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frame, root).write.parquet(f"{tmp_path}/{number}")
        frame = spark.read.parquet(f"{tmp_path}/{number}")
        assert frame.count() == 0 and (number == 4 or frame.columns == COLUMNS)


def test_clashing_columns_change_nothing(spark, stages, tmp_path):
    """Columns named like those that operators add come through, and the rows are those without them."""
    found, _, root = stages
    extra = ["whole_row", "key", "row", "doc", "view", "keep", "score", "fp", "first_row", "spans"]
    spark.read.parquet(f"{root}/documents.parquet").withColumns({c: F.lit(c) for c in extra}).write.parquet(f"{tmp_path}/documents")
    frame = spark.read.parquet(f"{tmp_path}/documents")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        stage(spark, frame, root).write.parquet(f"{tmp_path}/{number}")
        frame = spark.read.parquet(f"{tmp_path}/{number}")
        assert frame.columns == COLUMNS + extra and frame.where(" OR ".join(f"`{c}` <> '{c}'" for c in extra)).isEmpty()
        # of equal rows any may stay
        assert Counter(map(str, (r[:2] for r in map(tuple, frame.select(COLUMNS).collect())))) == Counter(str(r[:2]) for r in found[number + 1])
