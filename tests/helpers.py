"""What several test modules share; it has a name of its own, since tests/llm has a conftest too."""


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())
