"""Query of the language identification; checked by its accuracy on held-out documents."""

from tablework.llm.language_id import fit, held_out, identify
from tablework.llm.registry import query
from tablework.llm.tables import read


@query("op7_language_id")
def op7_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
