"""Labels without a document take no place in the sample."""

from stratalake.llm import linear


def test_sample_is_of_labels_with_a_document(spark):
    texts = [(i, "lorem ipsum dolor " + ("vile scum " if i % 2 else "sit amet ") * 5) for i in range(20)]
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id int, toxic int")
    model = linear.fit(docs, labels, max_labels=20)
    assert (model == linear.fit(docs, labels.where("doc_id < 20"), max_labels=20)).all()
    scores = {r.doc_id: r.score for r in linear.score(docs, model).collect()}
    assert all((scores[i] >= linear.THRESHOLD) == (i % 2 == 1) for i in range(20))
