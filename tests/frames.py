"""Small DataFrames and a plain reference distance for the tests."""


def one_col(spark, values, name="s"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def plain_distance(a, b):
    """Levenshtein distance of two sequences, one row of the table at a time."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left = row[:]
        row[0] = i
        for j, y in enumerate(b, 1):
            row[j] = min(left[j] + 1, row[j - 1] + 1, left[j - 1] + (x != y))
    return row[-1]
