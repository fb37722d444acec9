"""Figure pages read by a model: which pages, one request each, and payloads that know their page.

The page that was shown decides, whatever page an answer's items name.  A page whose answer holds no item is asked once
more of a second model where there is one; an answer that is empty then as well stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.operators import answers as A
from attestor.operators.providers import Provider, call_provider
from attestor.operators.text import figure_pages
from attestor.plans.datasets import Dataset


def page_requests(pages: DataFrame, most: int = 12, least_drawings: int = 12) -> DataFrame:
    """(custom_id, document_id, page_no, image) of the pages that likely hold a figure.

    ``pages`` has document_id, page_no, body, n_images, n_drawings and image (binary).  Pages are chosen without
    their images, which are joined to the few that stay.
    """
    chosen = figure_pages(pages.select("document_id", "page_no", "body", "n_images", "n_drawings"), "document_id", most, least_drawings)
    few = chosen.select("document_id", "page_no")
    return pages.select("document_id", "page_no", "image").join(few, ["document_id", "page_no"]).select(
        F.concat_ws("-p", "document_id", F.col("page_no").cast("string")).alias("custom_id"), "document_id", "page_no", "image"
    )


def empty(payload: Column, ds: Dataset) -> Column:
    """Whether a payload has no item in any of the dataset's lists; a null one has none."""
    some = F.lit(False)
    for name in ds.lists:
        some = some | (F.coalesce(F.size(F.try_variant_get(payload, f"$.{name}", "array<variant>")), F.lit(0)) > 0)
    return payload.isNull() | ~some


def page_payloads(requests: DataFrame, answers: DataFrame, ds: Dataset, second: DataFrame | None = None) -> DataFrame:
    """(custom_id, document_id, page_no, payload, escalated): each page's first answer, or the second's where it is empty.

    ``answers`` and ``second`` are (custom_id, answer), one for each id; a page without any is left out.
    """
    read = answers.select("custom_id", A.value(F.col("answer")).alias("payload"))
    out = requests.select("custom_id", "document_id", "page_no").join(read, "custom_id", "left").withColumn("escalated", F.lit(False))
    if second is not None:
        again = second.select("custom_id", A.value(F.col("answer")).alias("_again"))
        none = empty(F.col("payload"), ds)
        out = out.join(again, "custom_id", "left").withColumns({"escalated": none, "payload": F.when(none, F.coalesce("_again", "payload")).otherwise(F.col("payload"))}).drop("_again")
    return out.where("payload is not null")


def read_pages(requests: DataFrame, provider: Provider, ds: Dataset, escalate: Provider | None = None, tasks: int | None = None, retries: int = 9, wait: float = 1.0) -> DataFrame:
    """``page_payloads`` of a provider that takes an image's bytes; only empty pages go to ``escalate``.

    Calls run in tasks and lazily: write the result before several queries read it.
    """
    ask = lambda rows, p: call_provider(rows, p, tasks, retries, wait, "image").where("status = 'succeeded'").select("custom_id", "answer")
    first = ask(requests, provider)
    if escalate is None:
        return page_payloads(requests, first, ds)
    kept = first.where(~empty(A.value(F.col("answer")), ds)).select("custom_id")
    return page_payloads(requests, first, ds, ask(requests.join(kept, "custom_id", "left_anti"), escalate))


def routed(payloads: DataFrame, docs: DataFrame) -> DataFrame:
    """Payloads with the columns of their documents and ``page_no``, as ``payload_records`` takes them.

    A document's content may stand in ``docs`` more than once; each then gets the page's records.
    """
    rows = payloads.select("document_id", "page_no", F.col("page_no").cast("int").alias("chunk_index"), "payload")
    return docs.drop("text").join(rows, "document_id")
