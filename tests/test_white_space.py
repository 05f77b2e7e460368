"""White space is tidied in every document, against a plain statement of it."""

import re

from tessera.plans import catalog

SF = "/root/testdata/sf0.01"
#: The white space of Unicode without the line feed.
WHITE = "\t\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def tidied(text):
    if text is None:
        return None
    text = re.sub(f"[{WHITE}]+(?=\n|\\Z)", "", text)
    return re.sub("\n{4,}", "\n\n\n", text).strip()


def test_all_documents_are_tidied(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["text"] for r in catalog.queries()["htm_03_white_space"](spark, SF).collect()}
    assert len(got) == 1000 and got == {d: tidied(t) for d, t in docs.items()}
