from pathlib import Path

import numpy as np
import pytest

from quern.functions import encoders
from quern.operators import vector
from quern.sources.encodings import EncodingStore


def counting(folder: str):
    """The default encoder, which leaves a line per text it encodes."""
    def load():
        inner = encoders.hashed_bag_of_words(16)()

        def encode(texts):
            import os
            import uuid
            if texts:
                with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                    f.write("\n".join(t or "-" for t in texts) + "\n")
            return inner(texts)
        return encode
    return load


@pytest.fixture()
def store(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    return EncodingStore(spark, str(tmp_path / "store"), "bag-1.0", 16, counting(str(tmp_path / "calls"))), tmp_path / "calls"


def encoded(calls: Path) -> list[str]:
    return sorted(line for f in calls.iterdir() for line in f.read_text().splitlines())


def test_no_text_passes_the_encoder_twice(spark, store):
    store, calls = store
    first = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None), (4, "")] + [(i, "copy") for i in range(5, 300)], "id int, t string")
    assert store.lookup(first, "t", "v").where("v IS NULL").count() == 299
    assert store.add(first, "t") == 3 and encoded(calls) == ["-", "a b", "copy"]
    assert store.add(first, "t") == 0 and len(encoded(calls)) == 3
    more = first.unionByName(spark.createDataFrame([(300, "new"), (301, "copy")], "id int, t string"))
    got = {r.id: r.v for r in store.encode(more, "t", "v").collect()}
    assert encoded(calls) == ["-", "a b", "copy", "new"]
    plain = {r.id: r.v for r in encoders.dense_encode(more, {"t": "v"}, 16).collect()}
    assert got.keys() == plain.keys() and all(np.array_equal(got[i], plain[i]) for i in plain)
    assert store.stored().count() == 4


def test_loads_side_by_side_and_other_encoders(spark, store, tmp_path):
    store, calls = store
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "id int, t string")
    store.add(docs, "t")
    # Another load that began before the first one ended stores the same texts again.
    twin = next(Path(store.folder).glob("load-*"))
    spark.read.parquet(str(twin)).write.parquet(store.folder + "/load-twin")
    assert store.stored().count() == 2 and store.lookup(docs, "t", "v").count() == 2
    other = EncodingStore(spark, str(tmp_path / "store"), "bag-1.1", 16)
    assert other.stored().count() == 0 and other.add(docs, "t") == 2
    assert EncodingStore(spark, str(tmp_path / "store"), "bag-1.1", 16).add(docs.limit(0), "t") == 0
    with pytest.raises(ValueError):
        EncodingStore(spark, str(tmp_path), "../out", 16)


def test_search_over_the_store(spark, store):
    store, calls = store
    docs = spark.createDataFrame([(i, f"w{i % 7} w{i % 5} all") for i in range(60)], "doc_id bigint, t string")
    queries = spark.createDataFrame([(1, "w1 w2"), (2, "all"), (3, "")], "query_id bigint, query_text string")
    hits = lambda s: sorted(map(tuple, vector.neural_topk(queries, docs, "t", 4, 16, store=s).collect()))
    assert hits(store) == hits(None)
    before = len(encoded(calls))
    assert hits(store) == hits(None) and len(encoded(calls)) == before == 35 + 3
    with pytest.raises(ValueError):
        vector.neural_topk(queries, docs, "t", 4, 8, store=store)
