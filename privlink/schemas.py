"""Fixed schemas for every input and hand-off table.

Flat tables bind by position when read from CSV, so column order here is
part of the contract, not a matter of taste.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# -- nested inputs ---------------------------------------------------------

CODING = T.StructType([T.StructField("code", S), T.StructField("display", S)])
HUMAN_NAME = T.StructType(
    [T.StructField("family", S), T.StructField("given", T.ArrayType(S))]
)

RESOURCE = T.StructType(
    [
        T.StructField("resourceType", S),
        T.StructField("id", S),
        # Condition
        T.StructField(
            "code", T.StructType([T.StructField("coding", T.ArrayType(CODING))])
        ),
        T.StructField("assertedDate", S),
        T.StructField("onsetDateTime", S),
        # raw FHIR choice-field name and the nested spelling some readers expose
        T.StructField("abatementDateTime", S),
        T.StructField("abatement", T.StructType([T.StructField("dateTime", S)])),
        T.StructField("subject", T.StructType([T.StructField("reference", S)])),
        # Patient
        T.StructField(
            "identifier", T.ArrayType(T.StructType([T.StructField("value", S)]))
        ),
        T.StructField("name", T.ArrayType(HUMAN_NAME)),
    ]
)

BUNDLE = T.StructType(
    [
        T.StructField("resourceType", S),
        T.StructField(
            "entry",
            T.ArrayType(
                T.StructType(
                    [T.StructField("fullUrl", S), T.StructField("resource", RESOURCE)]
                )
            ),
        ),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField(
            "user",
            T.StructType(
                [
                    T.StructField("id", S),
                    T.StructField("name", S),
                    T.StructField("screen_name", S),
                ]
            ),
        ),
        T.StructField("created_at", S),
        T.StructField("text", S),
    ]
)

MESSAGE_DOC = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE))])

# -- flat hand-off tables (order is binding) -------------------------------

PERSONAL_COLUMNS = [
    "SynSocial_UID",
    "name",
    "screen_name",
    "filename",
    "Given_Name",
    "Identifier",
    "Synthea_UID",
    "Family_Name",
]

CONDITIONS = T.StructType(
    [
        T.StructField("display", S),
        T.StructField("code", T.LongType()),
        T.StructField("assertedDate", S),
        T.StructField("abatementDate", S),
        T.StructField("Given_Name", S),
        T.StructField("Identifier", S),
        T.StructField("Synthea_UID", S),
        T.StructField("Family_Name", S),
    ]
)

MESSAGES = T.StructType(
    [
        T.StructField("SynSocial_UID", S),
        T.StructField("name", S),
        T.StructField("screen_name", S),
        T.StructField("created_at", S),
        T.StructField("text", S),
        T.StructField("filename", S),
    ]
)

LINKED = T.StructType(
    [
        T.StructField("SynSocial_UID", S),
        T.StructField("name", S),
        T.StructField("screen_name", S),
        T.StructField("created_at", T.DateType()),
        T.StructField("text", S),
        T.StructField("filename", S),
        T.StructField("display", S),
        T.StructField("code", T.LongType()),
        T.StructField("assertedDate", T.DateType()),
        T.StructField("abatementDate", T.DateType()),
        T.StructField("Given_Name", S),
        T.StructField("Identifier", S),
        T.StructField("Synthea_UID", S),
        T.StructField("Family_Name", S),
    ]
)


def protected(suffix: str) -> T.StructType:
    """Schema of a hashed (``_hashed``) or encrypted (``_encrypted``) copy."""
    clear = [f for f in LINKED.fields if f.name not in PERSONAL_COLUMNS]
    return T.StructType(
        clear + [T.StructField(f"{c}{suffix}", S) for c in PERSONAL_COLUMNS]
    )


KEY_RECORD = T.StructType(
    [
        T.StructField("Key", T.BinaryType()),
        T.StructField("Key-String", S),
        T.StructField("Date", T.DateType()),
        T.StructField("Note", S),
    ]
)

REPORT = T.StructType(
    [
        T.StructField("User_Count", T.FloatType()),
        T.StructField("Medical_Codes", T.LongType()),
        T.StructField("Message_Count", T.FloatType()),
        T.StructField("Avg_Msg_per_User", T.DoubleType()),
    ]
)

STATS = T.StructType(
    [
        T.StructField("Social-Media-Users", T.LongType()),
        T.StructField("Medical-Records", T.LongType()),
        T.StructField("Medical-Codes", T.LongType()),
    ]
)

# -- lineage documents -----------------------------------------------------

_REF = T.StructType(
    [
        T.StructField("guid", S),
        T.StructField("typeName", S),
        T.StructField(
            "uniqueAttributes", T.StructType([T.StructField("qualifiedName", S)])
        ),
    ]
)

LINEAGE_DOC = T.StructType(
    [
        T.StructField(
            "entity",
            T.StructType(
                [
                    T.StructField("typeName", S),
                    T.StructField(
                        "attributes",
                        T.StructType(
                            [
                                T.StructField("owner", S),
                                T.StructField("createTime", T.LongType()),
                                T.StructField("qualifiedName", S),
                                T.StructField("displayName", S),
                                T.StructField("name", S),
                                T.StructField("description", S),
                                T.StructField("userName", S),
                                T.StructField("startTime", T.LongType()),
                                T.StructField("endTime", T.LongType()),
                                T.StructField("processId", S),
                                T.StructField("inputs", T.ArrayType(_REF)),
                                T.StructField("outputs", T.ArrayType(_REF)),
                            ]
                        ),
                    ),
                ]
            ),
        )
    ]
)
