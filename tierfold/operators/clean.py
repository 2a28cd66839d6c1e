"""Raw documents to flat clean rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierfold.functions import dob_to_date, identifier_concat, int_array_to_string
from tierfold.operators.columns import only_patients, with_clean_partition

# Clean column -> path in the raw document, in output order.
PATIENT_COLUMNS = {
    "mongoId": "_id",
    "gender": "gender.value",
    "identifier": "identifier",
    "dateCreated": "dateCreated",
    "active": "active.value",
    "birthDate": "birthDate.value",
    "patientName": "lowerCaseName.text.value",
    "maritalStatus": "maritalStatus.text.value",
    "lastUpdated": "lastUpdated",
}
USER_COLUMNS = {
    "mongoId": "_id",
    **{
        name: name
        for name in (
            "email",
            "enabled",
            "firstName",
            "lastName",
            "phoneNo",
            "userType",
            "dateCreated",
            "lastLoginTimeStamp",
            "patientId",
            "dob",
            "gender",
            "countryCode",
            "userGroups",
            "lastUpdated",
        )
    },
}


def extract(
    raw: DataFrame,
    columns: dict[str, str],
    conversions: dict[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Select nested paths under flat names, converting the listed ones."""
    conversions = conversions or {}
    return raw.select(
        *(
            conversions.get(name, lambda c: c)(F.col(path)).alias(name)
            for name, path in columns.items()
        )
    )


def patient_rows(raw: DataFrame) -> DataFrame:
    """Flat patient rows without a partition date."""
    element = raw.schema["identifier"].dataType.elementType
    return extract(
        raw,
        PATIENT_COLUMNS,
        {
            "identifier": lambda c: identifier_concat(c, element),
            "birthDate": dob_to_date,
        },
    )


def clean_patient(raw: DataFrame) -> DataFrame:
    return with_clean_partition(patient_rows(raw))


def clean_user(raw: DataFrame) -> DataFrame:
    """Flat rows of those users that are patients."""
    rows = extract(
        only_patients(raw),
        USER_COLUMNS,
        {"dob": dob_to_date, "userGroups": int_array_to_string},
    )
    return with_clean_partition(rows)


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "patient": clean_patient,
    "user": clean_user,
}
