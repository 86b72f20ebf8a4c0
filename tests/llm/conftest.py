import pytest


DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with extra columns whose names the operators might use themselves."""
    def make(rows, clash=True):
        rows = [(*r, *[None] * (4 - len(r))) for r in rows]
        df = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOC)
        return df.selectExpr("*", "1 as id", "'x' as key", "2 as tag", "3 as kind", "0 as size", "'h' as hash", "5 as n",
                             "'v' as version", "7 as pos") if clash else df
    return make


#: Null and empty texts, a repeated row, a repeated id with another text, rows without an id, blanks only.
ODD = [(1, None), (2, ""), (3, "One line that is here twice.\nshort"), (3, "One line that is here twice.\nshort"),
       (4, "one LINE that is here twice.  \nshort\n"), (4, "another text with the same id as before"), (None, "no id at all"),
       (None, "One line that is here twice."), (5, " \t\n ")]
