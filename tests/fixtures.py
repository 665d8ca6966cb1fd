"""Small inbound files and configuration for pipeline tests (tier 2)."""

from __future__ import annotations

import os

FILE_CONFIG = """ConfigurationFileID|Source|Delimiter|TextQualifier|Account|DefaultCategory|FileNamePattern
1|bank|comma|"|Checking|Uncategorised|*.csv
2|shop|pipe||Store Card||*.txt
3|empty_cols|comma||Nobody||*.csv
"""

COLUMN_CONFIG = """ConfigurationFileID|ConfigurationColumnOrder|ColumnName_File|ColumnName_Bronze|ColumnName_Silver|Datatype|SilverEntity|SilverColumn|Transformation_BronzeToSilver_Type|Transformation_BronzeToSilver|ColumnIsInNaturalKey
1|1|Date|Date|Date|date|Transaction|Date|Direct||Yes
1|2|Amount|Amount|Amount|decimal(18,2)|Transaction|Amount|Direct||Yes
1|3|Description|Description|Description|string|Transaction|Description|Direct||Yes
2|1|Posted|Date|Date|date(M/d/yyyy)|Transaction|Date|Direct||Yes
2|2|Total|Amount|Amount|decimal(18,2)|Transaction|Amount|Expression|-Amount|Yes
2|3|Item|Description|Description|string|Transaction|Description|Direct||Yes
2|4|Dept|Category|Category|string|CategoryGUID|Name|Lookup||
"""


def write(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def build_inbound(root: str) -> dict[str, str]:
    """Config + one file per inbound case; returns name -> path."""
    write(f"{root}/Admin/ConfigurationFile.txt", FILE_CONFIG)
    write(f"{root}/Admin/ConfigurationColumn.txt", COLUMN_CONFIG)
    inb = f"{root}/Bronze/Inbound"
    files = {
        "good": write(f"{inb}/bank/good.csv",
                      "Date,Amount,Description\r\n2024-01-05,12.50,Coffee\r\n"
                      "2024-01-06,\"1,200.00\",Rent\r\n2024-01-06,\"1,200.00\",Rent\r\n"),
        "reordered": write(f"{inb}/bank/reordered.CSV",
                           "Description,Date,Amount\nGroceries,2024-02-01,40.10\n"
                           "\"Book, paper\",2024-02-02,(3.00)\n"),
        "extra": write(f"{inb}/bank/extra.csv", "Date,Amount,Description,Extra\n2024-01-01,1,a,b\n"),
        "missing": write(f"{inb}/bank/missing.csv", "Date,Amount\n2024-01-01,1\n"),
        "both": write(f"{inb}/bank/both.csv", "Date,Amount,Extra\n2024-01-01,1,b\n"),
        "duplicate": write(f"{inb}/bank/dup.csv", "Date,Amount,Description,Date\n2024-01-01,1,a,x\n"),
        "header_only": write(f"{inb}/bank/header_only.csv", "Date,Amount,Description\n"),
        "zero_byte": write(f"{inb}/bank/zero.csv", ""),
        "pdf": write(f"{inb}/bank/statement.pdf", "%PDF-1.4"),
        "nulls_bad": write(f"{inb}/bank/nulls.txt",
                           "Date,Amount,Description\n2024-03-01,NA,null\nnot a date,5.00,Bad date\n"
                           "2024-03-02,7.25,N/A\n"),
        "shop": write(f"{inb}/shop/orders.txt",
                      "Item|Dept|Posted|Total\nTea|Food|03/04/2024|$4.20\nPen|Office|03/05/2024|1.10\n"),
        "no_config": write(f"{inb}/unknown/x.csv", "Date,Amount,Description\n2024-01-01,1,a\n"),
    }
    return files
