from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> list[tuple]:
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def dicts(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def mdc(node: str = "N1", mts: str = "20240101101500+0100", names=("pmA", "pmB", "pmVec"), instances=()) -> str:
    """One counter document; instances are (moid, [(p, text), ...])."""
    mt = "".join(f"<mt>{n}</mt>" for n in names)
    mv = "".join(
        f"<mv><moid>{moid}</moid>" + "".join(f'<r p="{p}">{text}</r>' for p, text in results) + "</mv>"
        for moid, results in instances
    )
    return (
        f"<mdc><mfh><ffv>1</ffv><sn>SubNetwork=X,MeContext={node}</sn><st>A</st><vn>V</vn><cbt>20240101100000Z</cbt></mfh>"
        f"<md><neid><neun>{node}</neun><nedn>d</nedn><nesw>s</nesw></neid>"
        f"<mi><mts>{mts}</mts><gp>900</gp>{mt}{mv}</mi></md><mff><ts>20240101101500Z</ts></mff></mdc>"
    )


CELLS = (
    ("ManagedElement=1,Func=1,CellFDD=c1", [(0, "5"), (1, ""), (2, "1,2,3")]),
    ("ManagedElement=1,Func=1,CellFDD=c2", [(0, "7"), (1, "9"), (2, "4,5,6")]),
)
