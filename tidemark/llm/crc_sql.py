"""CRC-32 in SQL, for the questions behind the queries: the table of steps from its rule, and a fold."""

STEPS = """crc_steps AS (
  SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS steps FROM crc_steps WHERE k = 8)"""


def crc32(digits: str) -> str:
    """The unsigned CRC-32 of bytes given as hex digits; ``crc`` must be among the tables read."""
    data = f"list_transform(range(0, length({digits}) // 2), lambda i: CAST('0x' || substr({digits}, 2 * i + 1, 2) AS BIGINT))"
    fold = f"list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {data}), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))"
    return f"xor({fold}, 4294967295)"
