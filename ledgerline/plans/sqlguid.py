"""SQL text for the same stable GUID as ``functions.guid.stable_guid``.

Used by oracle SQL strings (DuckDB dialect) so both sides agree on keys.
"""


def sql_guid(namespace: str, expr: str) -> str:
    h = (f"md5(concat_ws(chr(31), '{namespace}', "
         f"coalesce(CAST({expr} AS VARCHAR), chr(1))))")
    return (f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), "
            f"substr({h}, 17, 4), substr({h}, 21, 12))")
