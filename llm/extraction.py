"""Main text of HTML pages: leaf blocks, labelled by a recurrent network, joined in page order."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm.block_labeller import Labeller, train
from llm.frames import slices
from llm.html_blocks import leaves
from llm.synthetic_pages import labelled_pages

TRAINING_PAGES, EPOCHS = 2200, 10


@lru_cache(2)
def labeller(pages: int = TRAINING_PAGES, epochs: int = EPOCHS, seed: int = 0) -> Labeller:
    """Trained on made-up pages; the same arguments give the same model."""
    return train(*labelled_pages(pages, seed), epochs=epochs, seed=seed)


def extract_text(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars, n_blocks, n_kept) for every row of pages.

    text joins the blocks labelled as main text by one line end; a null or empty page, or one without
    main text, gives the empty string. Character references are decoded and white space inside a block
    is one space; nothing else of a kept block changes. A very long, deep or broken page is read whole, in
    time linear in its length; a tag that never ends takes the rest of its page. Equal rows give equal rows; other columns of
    pages play no part.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model.p)  # fixed size, about 1 MB
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Labeller(shared.value)
        for batch in slices(batches, text=2):
            blocks = [leaves(h) if h else [] for h in batch.column(2).to_pylist()]
            kept = [[b.text for b, p in zip(page, q) if p >= 0.5] for page, q in zip(blocks, network.predict(blocks))]
            texts = ["\n".join(k) for k in kept]
            numbers = (np.array([len(x) for x in column], np.int64) for column in (texts, blocks, kept))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), *map(pa.array, numbers)], ["id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    chosen = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    schema = f"id {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars long, n_blocks long, n_kept long"
    return chosen.mapInArrow(run, schema).withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
