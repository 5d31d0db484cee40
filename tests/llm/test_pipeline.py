"""The pipeline's stages against brute-force versions, each on what its predecessor kept."""

import random
import re

from tokenizers import Tokenizer

import corpus_pipeline
from cellmart.llm import quality, queries
from cellmart.llm.tables import written
from cellmart.session import scratch_path

from .test_jaccard import brute as near_groups
from .test_small_ops import SPACES, brute_hits


def corpus(spark):
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("aeiounrst") for _ in range(rnd.randint(2, 8))) for _ in range(400)]

    def words(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    bench = [(i, " ".join(words(30))) for i in range(5)]
    docs, labels = [], []
    for i in range(240):
        good = i % 5 > 0
        if i > 20 and rnd.random() < 0.25:
            text = docs[rnd.randrange(20)][1]
            if rnd.random() < 0.6:
                parts = text.split(" ")
                parts[rnd.randrange(len(parts))] = "edited"
                text = " ".join(parts)
            elif rnd.random() < 0.5:
                text = text.replace(" ", "\n", 2)
            good = True
        else:
            parts = words(rnd.randint(40, 120))
            if rnd.random() < 0.15:
                parts[10:10] = rnd.choice(bench)[1].split(" ")
            text = " ".join(w if good or rnd.random() < 0.4 else w.upper() + "$$" for w in parts) + "."
        docs.append((i, text))
        labels.append((i, int(good), 0))
    docs += [(900, None), (901, ""), (902, docs[3][1] + " ")]
    path = scratch_path(spark, "pipeline-test")
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long"
                          ).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, bench


def test_stages(spark):
    path, docs, bench = corpus(spark)
    frame = spark.read.parquet(f"{path}/documents.parquet")
    columns = frame.columns
    texts = dict(docs)
    scores = {r["doc_id"]: r["predicted"] for r in quality.quality_scores(frame, spark.read.parquet(f"{path}/labels.parquet")).collect()}
    kept = {i for i, p in scores.items() if p}
    assert len(kept) < len(docs) - 20

    def exact(ids):
        groups = {}
        for i in ids:
            groups.setdefault(SPACES.sub("", texts[i] or ""), []).append((-len(texts[i] or ""), i))
        return {min(g)[1] for g in groups.values()}

    def near(ids):
        return {i for i, (_, c) in near_groups([(i, texts[i]) for i in sorted(ids)], 5, 80).items() if i == c}

    def clean(ids):
        ids = sorted(ids)
        return {i for i, hit in zip(ids, brute_hits([(i, texts[i]) for i in ids], bench, 13)) if not hit[3]}

    want = [kept]
    for step in (exact, near, clean):
        want.append(step(want[-1]))
        assert len(want[-1]) < len(want[-2])
    for (name, stage), ids in zip(corpus_pipeline.STAGES[:4], want):
        frame = written(stage(spark, frame, path), name)
        assert frame.columns == columns
        rows = frame.collect()
        assert {r["doc_id"]: r["text"] for r in rows} == {i: texts[i] for i in ids} and len(rows) == len(ids), name
    library = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))
    out = corpus_pipeline.run(spark, path).collect()
    assert {r["doc_id"] for r in out} == want[-1] and len(out) == len(want[-1])
    for r in out:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and bytes(r["ids"]) == b"".join(i.to_bytes(4, "little") for i in ids)


def test_stages_take_an_empty_table(spark):
    path, _, _ = corpus(spark)
    frame = spark.read.parquet(f"{path}/documents.parquet").where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        frame = written(stage(spark, frame, path), name)
        assert frame.count() == 0


def test_every_operator_is_registered():
    names = list(queries.QUERIES)
    assert [re.match(r"op(\d+)_", n).group(1) for n in names] == [str(i) for i in range(1, 14)]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "encode"]
    assert set(queries.ORACLES) <= set(names)
