import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from millwright.llm import queries


def planted(spark, folder):
    draw = random.Random(11)
    vocabulary = [f"w{n}" for n in range(3000)]
    item = " ".join(f"quiz{n}" for n in range(14))
    docs, labels = {}, []
    for n in range(300):
        words = draw.choices(vocabulary, k=60)
        if n % 10 == 1:
            words.insert(30, "blorf")
        if n % 10 == 2:
            words.insert(5, item)
        docs[n] = " ".join(words)
        labels.append((n, 1, int(n % 10 == 1)))
    for n in range(300, 330):
        docs[n] = docs[n - 300 + 3 if n < 310 else n - 300]
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_each_stage_and_the_whole(spark, tmp_path):
    docs = planted(spark, str(tmp_path))
    rows = queries.table(spark, str(tmp_path), "documents")
    columns, seen = rows.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{tmp_path}/stage-{name}"
        stage(spark, rows, str(tmp_path)).write.parquet(path)
        rows = spark.read.parquet(path)
        assert rows.columns == columns
        seen.append({r.doc_id for r in rows.select("doc_id").collect()})
        assert rows.count() == len(seen[-1])
    toxic = {i for i, t in docs.items() if "blorf" in t.split()}
    assert seen[0] == set(docs) - toxic
    first = {}
    for i in sorted(seen[0]):
        first.setdefault(docs[i], i)
    assert seen[1] == set(first.values())
    assert seen[2] == {i for i in seen[1] if "quiz3" not in docs[i]}
    assert seen[3] == seen[2]
    final = corpus_pipeline.run(spark, str(tmp_path)).orderBy("start").collect()
    assert {r.doc_id for r in final} == seen[3]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at = 0
    for r in final:
        assert (r.start, r.n_tokens) == (at, len(tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids) + 1)
        at += r.n_tokens
    # the files follow the mixture, not the ids
    assert [r.doc_id for r in final] != sorted(seen[3])
