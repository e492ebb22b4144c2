from datetime import datetime


def ts(text):
    return datetime.fromisoformat(text)


def rows(df, *order):
    ordered = df.orderBy(*order) if order else df
    return [tuple(r) for r in ordered.collect()]
