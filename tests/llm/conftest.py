import textwrap

import pytest

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, topic string, "
              "fingerprint string, measure double, text_hash long, label string, tokens string, at long, key long")


# A notice wrapped over lines, in the middle of other words.
WRAPPED = "\n".join(textwrap.wrap(
    " ".join(f"w{i}" for i in range(50)) + " Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: " + " ".join(f"v{i}" for i in range(60)), 72))


def edge_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows; the other columns clash with working names."""
    long_text = "Thint onder ed an the " * 30_000
    plain = "The and ondre of thint ed onder an the edhe. Ther inon the and of\nOndre the an edhe onthe. " * 4
    texts = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t ", None, None), (4, long_text, "en", "a"),
             (5, plain, "en", "b"), (5, plain, "en", "b"), (6, plain, "fr", "b"), (7, plain + " x", None, "a"),
             (None, plain, "en", None), (None, None, None, None), (8, "123 456 !!! ???", "de", "c"),
             (9, "one", "en", "c"), (10, "Licensed under the MIT License.", "en", "c"), (11, "é中\U0001F600 á", "xx", "c")]
    return [(i, t, lang, s, None, None, None, None, None, None, None, None, None, None) for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def edge_dirs(edge_docs, no_docs, spark, tmp_path_factory):
    """Folders of tables: (edge cases, all empty)."""
    out = []
    for name, docs in (("edge", edge_docs), ("empty", no_docs)):
        folder = tmp_path_factory.mktemp(name)
        docs.write.parquet(f"{folder}/documents.parquet")
        rows = [(5, 1, 0), (5, 0, 1), (6, 0, 1), (7, 1, 0), (None, 1, 1), (9, None, None), (99, 1, 1)]
        spark.createDataFrame(rows if name == "edge" else [], "doc_id long, quality int, toxic int").write.parquet(
            f"{folder}/labels.parquet")
        vectors = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0]), (3, []), (4, None), (5, [None, 1.0]),
                   (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (20, [-0.5, 0.01]), (None, [1.0, 1.0]), (40, [0.0, 0.0, 3.0])]
        vectors += [(100, [1.0, 0.5]), (100, [2.0, 0.5]), (100, [1.0, 0.5]), (200, [3.0]), (700, [1.0, -1.0]), (300, []), (400, [0.0, 0.0])]
        labels = [0, 0, 1, 1, 0, 0, 0, 0, 1, 2, 1, None, 0, 1, 0, 1, 0, 2]
        spark.createDataFrame([(*v, labels[k % len(labels)]) for k, v in enumerate(vectors)] if name == "edge" else [],
                              "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
        items = [(1, "the and ondre"), (1, "the and ondre"), (2, None), (3, ""), (None, "THE mit license, the"), (4, "absent"),
                 (5, "é中\U0001F600 á one " * 50), (6, "!!!")]
        spark.createDataFrame([(*x, 1, "score") for x in items] if name == "edge" else [],
                              "item_id long, text string, item int, terms string").write.parquet(f"{folder}/benchmark.parquet")
        out.append(str(folder))
    return out
