"""Small messages with the shapes that occur in practice."""

from __future__ import annotations

HEADER = '<?xml version="1.0" encoding="utf-8"?>'


def fields(segment: str, n: int) -> str:
    return "".join(f"<{segment}_F{i:02d}>v{i}</{segment}_F{i:02d}>" for i in range(n))


def segments(counts: dict[str, tuple[int, int]]) -> str:
    """``{name: (occurrences, fields)}``, occurrences of different segments interleaved."""
    rounds = max((n for n, _ in counts.values()), default=0)
    out = []
    for i in range(rounds):
        for name, (n, width) in counts.items():
            if i < n:
                out.append(f"<{name}>  {fields(name, width)} </{name}>")
    return "".join(out)


def message(request: dict, response: dict) -> str:
    extra = (
        "<Vendor>ABC</Vendor><RecordType>Claim</RecordType><DateSwitched>03/07/2031 08:15:00.25 PM</DateSwitched>"
        "<SwitchTransactionId>100200300400500607</SwitchTransactionId><Store><City>Springfield</City></Store>"
        "<Prescriber><SecondaryAddress/></Prescriber><Drug><UnitPrice>2.71828</UnitPrice></Drug>"
    )
    return (
        f"{HEADER}<ClaimBilling><Supplemental>{extra}</Supplemental><NcpdpRequest>{segments(request)}</NcpdpRequest>"
        f"<NcpdpResponse>{segments(response)}</NcpdpResponse></ClaimBilling>"
    )


SINGLE = message(
    {"S_HD": (1, 9), "S_01": (1, 8), "S_04": (1, 3), "S_07": (1, 14), "S_03": (1, 3), "S_11": (1, 7)},
    {"S_HD": (1, 7), "S_25": (1, 2), "S_21": (1, 7), "S_22": (1, 2), "S_23": (1, 11)},
)
REPEATED_REQUEST = {
    "S_HD": (1, 9),
    "S_01": (1, 12),
    "S_04": (1, 7),
    "S_07": (4, 19),
    "S_02": (4, 2),
    "S_03": (4, 9),
    "S_11": (4, 8),
}
REPEATED_RESPONSE = {
    "S_HD": (1, 7),
    "S_25": (1, 4),
    "S_29": (1, 3),
    "S_21": (4, 8),
    "S_22": (4, 2),
    "S_24": (4, 20),
    "S_26": (4, 2),
    "S_28": (4, 10),
}
REPEATED = message(REPEATED_REQUEST, REPEATED_RESPONSE)
OPTIONAL = ("S_05", "S_06", "S_08", "S_09", "S_10", "S_13", "S_14", "S_15", "S_16")
FILLED = message(
    {**REPEATED_REQUEST, **{name: (4, 1) for name in OPTIONAL}}, {**REPEATED_RESPONSE, "S_23": (4, 1)}
)
