"""The registered queries as SQL over the same tables."""

from __future__ import annotations

RAW_PATIENT = """raw_patient AS (
    SELECT c_custkey AS _id,
           CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
           CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 0 ELSE 2 END
               AS identifiers,
           CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN ''
                ELSE 'cust_' || c_mktsegment || '_' || c_name || ','
                     || CASE WHEN c_custkey % 5 = 0 THEN 'null' ELSE 'nat' END
                     || '_N_' || c_nationkey END AS identifier,
           TIMESTAMP '2020-01-01' + to_days(CAST(c_custkey % 90 AS INTEGER)) AS dateCreated,
           c_acctbal > 0 AS active,
           TIMESTAMP '1950-01-01 13:45:00' + to_days(CAST(c_custkey % 20000 AS INTEGER)) AS born,
           lower(c_name) AS name,
           c_mktsegment AS maritalStatus,
           TIMESTAMP '2020-01-01'
               + to_days(CAST(c_custkey % 90 + c_custkey % 13 AS INTEGER)) AS lastUpdated,
           CASE WHEN c_custkey % 8 <> 0 THEN c_name END AS city,
           CASE WHEN c_custkey % 8 <> 0 THEN n_name END AS country,
           c_custkey % 10 = 0 AS anonymous
    FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

CLEAN_PATIENT = f"""{RAW_PATIENT},
clean_patient AS (
    SELECT _id AS "mongoId", gender, identifier, dateCreated AS "dateCreated", active,
           CAST(born AS DATE) AS "birthDate", name AS "patientName",
           maritalStatus AS "maritalStatus", lastUpdated AS "lastUpdated",
           CAST(dateCreated AS DATE) AS "partitionDate"
    FROM raw_patient)"""

RAW_USER = """raw_user AS (
    SELECT o_orderkey AS _id, 'u' || o_orderkey || '@example.org' AS email,
           o_totalprice > 100000 AS enabled, 'F' || o_custkey AS "firstName",
           'L' || o_orderkey AS "lastName", CAST(o_orderkey AS VARCHAR) AS "phoneNo",
           CASE WHEN o_orderstatus = 'F' THEN 'PATIENT' ELSE 'STAFF' END AS "userType",
           o_orderdate AS "dateCreated",
           o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS "lastLoginTimeStamp",
           o_custkey AS "patientId",
           TIMESTAMP '1960-06-01 08:00:00' + to_days(CAST(o_orderkey % 9000 AS INTEGER)) AS dob,
           CASE WHEN o_orderkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
           '91' AS "countryCode",
           CASE WHEN o_orderkey % 9 = 0 OR o_orderkey % 10 = 0 THEN ''
                ELSE (o_orderkey % 5) || ',' || (o_custkey % 7) END AS "userGroups",
           o_orderdate AS "lastUpdated"
    FROM orders)"""

CLEAN_USER = f"""{RAW_USER},
clean_user AS (
    SELECT _id AS "mongoId", email, enabled, "firstName", "lastName", "phoneNo", "userType",
           "dateCreated", "lastLoginTimeStamp", "patientId", CAST(dob AS DATE) AS dob, gender,
           "countryCode", "userGroups", "lastUpdated",
           CAST("dateCreated" AS DATE) AS "partitionDate"
    FROM raw_user WHERE "userType" = 'PATIENT')"""

PRIMARY = """SELECT "mongoId", gender, identifier, "dateCreated", active, "birthDate",
    "patientName", "maritalStatus", "lastUpdated", "partitionDate" AS "updatedDate"
    FROM clean_patient"""
SECONDARY = """SELECT "mongoId" AS "userMongoId", email, enabled, "firstName", "lastName",
    "phoneNo", "userType", "dateCreated" AS "userDateCreated", "lastLoginTimeStamp", "patientId",
    dob, gender AS "userGender", "countryCode", "userGroups", "lastUpdated" AS "userLastUpdated",
    "partitionDate" AS "userPartitionDate" FROM clean_user"""
JOINED = f"""WITH {CLEAN_PATIENT}, {CLEAN_USER}
    SELECT p.*, u.* FROM ({PRIMARY}) p JOIN ({SECONDARY}) u ON p."mongoId" = u."patientId" """
ACTIVITY = f"""WITH {CLEAN_USER}
    SELECT enabled, CAST("lastLoginTimeStamp" AS DATE) AS "lastLoginDate",
           "userGender", "userPartitionDate", COUNT(*) AS "count"
    FROM ({SECONDARY}) GROUP BY 1, 2, 3, 4"""

FLAT = f"""WITH {RAW_PATIENT}
    SELECT _id, gender, name, identifiers, dateCreated AS "dateCreated",
           lastUpdated AS "lastUpdated" FROM raw_patient"""
FLAT_DATED = f"""WITH {RAW_PATIENT}
    SELECT _id, gender, name, identifiers, lastUpdated AS "lastUpdated",
           CAST(lastUpdated AS DATE) AS "partitionDate" FROM raw_patient"""
ADDRESS = f"WITH {RAW_PATIENT} SELECT _id, city, country FROM raw_patient"


def _rekeyed(factor: int, name: str, shift: str) -> str:
    key = f'"mongoId" * {factor}'
    days = f"to_days(CAST(({key}) % 30 + {shift} AS INTEGER))"
    return f"""SELECT {key} AS "mongoId", gender, identifier,
        TIMESTAMP '2020-01-01' + {days} AS "dateCreated", active, "birthDate",
        {name} AS "patientName", "maritalStatus", "lastUpdated",
        CAST(TIMESTAMP '2020-01-01' + {days} AS DATE) AS "partitionDate"
        FROM clean_patient"""


SOURCE_SHIFT = 'CASE WHEN "mongoId" * 3 % 4 = 0 THEN 1 ELSE 0 END'
MERGE_SIDES = f"""{CLEAN_PATIENT},
    old AS ({_rekeyed(2, '"patientName"', "0")}),
    new AS ({_rekeyed(3, 'upper("patientName")', SOURCE_SHIFT)})"""
HIT = 'new."mongoId" = old."mongoId" AND new."partitionDate" = old."partitionDate"'
MERGED = f"""WITH {MERGE_SIDES}
    SELECT new.* FROM old JOIN new ON {HIT}
    UNION ALL SELECT old.* FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE {HIT})
    UNION ALL SELECT new.* FROM new
        WHERE NOT EXISTS (SELECT 1 FROM old WHERE new."mongoId" = old."mongoId")"""

EVOLVED = f"""WITH {MERGE_SIDES}
    SELECT new."mongoId", new."patientName", new."maritalStatus", CAST(NULL AS VARCHAR) AS tier,
           'merged' AS origin, new."partitionDate" FROM old JOIN new ON {HIT}
    UNION ALL
    SELECT "mongoId", "patientName", NULL, NULL, NULL, "partitionDate" FROM old
        WHERE NOT EXISTS (SELECT 1 FROM new WHERE {HIT})
    UNION ALL
    SELECT -"mongoId" - 1, "patientName", "maritalStatus", 'appended', NULL, "partitionDate"
        FROM old
    UNION ALL
    SELECT "mongoId", "patientName", "maritalStatus", NULL, 'merged', "partitionDate" FROM new
        WHERE NOT EXISTS (SELECT 1 FROM old WHERE new."mongoId" = old."mongoId")"""

REPAIR = """WITH input AS (
        SELECT event_id, CASE WHEN event_id % 2 = 0 THEN ts
               ELSE date_trunc('second', ts) + to_milliseconds(event_id % 1000) END AS t
        FROM events),
    split AS (SELECT event_id, t, microsecond(t) % 1000000 AS us FROM input)
    SELECT event_id, t, CASE WHEN us % 1000 = 0 AND us % 10000 <> 0 THEN t
           ELSE date_trunc('second', t) + to_milliseconds(136) END AS repaired
    FROM split"""

JSON_LINES = """WITH lines AS (
        SELECT c_custkey, c_name, DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS born,
               c_custkey % 11 <> 0 AS good FROM customer)
    SELECT CASE WHEN good THEN c_custkey END AS _id, CASE WHEN good THEN c_name END AS name,
           CASE WHEN good THEN born END AS born,
           CASE WHEN good THEN 1577836800250 + c_custkey % 60 * 1000 END AS seen_ms,
           CASE WHEN NOT good THEN '{"_id":' || c_custkey || ',"name":"' || c_name || '","born":"'
               || born || '","seen":"2020-01-01T00:00:'
               || lpad(CAST(c_custkey % 60 AS VARCHAR), 2, '0') || '.250Z"' END AS bad_line
    FROM lines"""

PATIENT_ROWS = f"""WITH {CLEAN_PATIENT} SELECT * FROM clean_patient"""
USER_ROWS = f"""WITH {CLEAN_USER} SELECT * FROM clean_user"""

ORACLE_SQL: dict[str, str] = {
    "scan_collection": FLAT,
    "scan_layer_table": f"""WITH {RAW_USER}
        SELECT * EXCLUDE ("userGroups"), CAST("lastUpdated" AS DATE) AS "partitionDate"
        FROM raw_user""",
    "scan_parquet_uri": "SELECT * FROM orders",
    "table_or_empty": "SELECT c_custkey, c_name, TRUE AS other_is_absent FROM customer",
    "scan_json_permissive": JSON_LINES,
    "scan_by_ids": f"""{FLAT} WHERE _id IN
        (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
    "scan_by_date_range": f"""{FLAT} WHERE lastUpdated > TIMESTAMP '2020-01-10'
        AND lastUpdated < TIMESTAMP '2020-03-12' AND NOT anonymous ORDER BY _id""",
    "partition_date_raw": f"""WITH {RAW_PATIENT} SELECT _id, lastUpdated AS "lastUpdated",
        CAST(lastUpdated AS DATE) AS "partitionDate" FROM raw_patient""",
    "partition_date_clean": f"""WITH {RAW_PATIENT} SELECT _id, dateCreated AS "dateCreated",
        CAST(dateCreated AS DATE) AS "partitionDate" FROM raw_patient""",
    "flatten_nested": f"""WITH {RAW_PATIENT} SELECT _id AS "mongoId", gender, active,
        born AS "birthDate", name AS "patientName", maritalStatus AS "maritalStatus"
        FROM raw_patient""",
    "clean_patient": PATIENT_ROWS,
    "clean_user": USER_ROWS,
    "rename_for_join": f"WITH {CLEAN_USER} {SECONDARY}",
    "rename_primary": f"WITH {CLEAN_PATIENT} {PRIMARY}",
    "copy_column": ADDRESS,
    "conform_nested": f"""WITH {RAW_PATIENT} SELECT _id, city, country,
        CAST(NULL AS VARCHAR) AS "postalCode", CAST(NULL AS VARCHAR) AS state,
        CAST(NULL AS VARCHAR) AS text, CAST(NULL AS VARCHAR) AS "useCode" FROM raw_patient""",
    "drop_columns": f"""WITH {RAW_PATIENT} SELECT _id, '_id,gender,identifier,dateCreated,active,'
        || 'birthDate,lowerCaseName,maritalStatus,lastUpdated,isAnonymous' AS column_names,
        gender, lastUpdated AS "lastUpdated", anonymous AS value FROM raw_patient""",
    "filter_user_type": f"""WITH {RAW_USER} SELECT _id, "userType", "patientId"
        FROM raw_user WHERE "userType" = 'PATIENT'""",
    "filter_not_null": f"{ADDRESS} WHERE city IS NOT NULL",
    "identifier_concat": f"WITH {RAW_PATIENT} SELECT _id, identifier FROM raw_patient",
    "dob_to_date": f"WITH {RAW_USER} SELECT _id, CAST(dob AS DATE) AS dob FROM raw_user",
    "int_array_to_string": f"""WITH {RAW_USER} SELECT _id, "userGroups" FROM raw_user""",
    "timestamp_repair": REPAIR,
    "sql_functions": f"""WITH {RAW_PATIENT}, {RAW_USER}
        SELECT p._id AS patient, u._id AS "user", p.identifier, CAST(u.dob AS DATE) AS dob,
               u."userGroups", CASE WHEN microsecond(u."dateCreated") % 1000 = 0
                   AND microsecond(u."dateCreated") % 10000 <> 0 THEN u."dateCreated"
                   ELSE date_trunc('second', u."dateCreated") + to_milliseconds(136)
                   END AS repaired
        FROM raw_patient p JOIN raw_user u ON p._id = u."patientId" """,
    "patient_user_join": JOINED,
    "user_activity_agg": ACTIVITY,
    "row_count": f"WITH {CLEAN_USER} SELECT COUNT(*) AS row_count FROM clean_user",
    "merge_upsert": MERGED,
    "merge_written": MERGED,
    "merge_resumed": MERGED,
    "latest_per_key": FLAT_DATED,
    "schema_evolution": EVOLVED,
    "append_partitioned": f"{FLAT_DATED} UNION ALL ({FLAT_DATED})",
    "create_partitioned": PATIENT_ROWS,
    "append_json": FLAT_DATED,
    "mart_overwrite": USER_ROWS,
    "stale_files": f"""WITH {CLEAN_PATIENT} SELECT DISTINCT "partitionDate" FROM clean_patient""",
    "sql_over_view": f"""WITH {RAW_PATIENT} SELECT lastUpdated AS "lastUpdated" FROM raw_patient""",
    "sql_over_path": f"""WITH {RAW_PATIENT} SELECT _id, born AS "birthDate",
        maritalStatus AS "maritalStatus" FROM raw_patient""",
    "job_raw_ingest": FLAT_DATED,
    "job_raw_ingest_json": FLAT_DATED,
    "job_raw_ingest_quarantine": f"""WITH {RAW_PATIENT}
        SELECT CASE WHEN _id % 5 <> 0 THEN _id END AS _id,
               CASE WHEN _id % 5 <> 0 THEN gender END AS gender,
               CASE WHEN _id % 5 = 0 THEN '{{"_id":' || _id || ',"gender":' END AS document
        FROM raw_patient""",
    "job_raw_ingest_drift": f"""SELECT _id, CASE WHEN _id % 2 = 0 THEN gender END AS gender,
        name, identifiers, "lastUpdated", "partitionDate",
        CASE WHEN _id % 2 = 1 THEN _id % 3 END AS ward, 1 + _id % 2 AS "ingestBatch"
        FROM ({FLAT_DATED})""",
    "job_clean_patient": PATIENT_ROWS,
    "job_clean_incremental": PATIENT_ROWS,
    "job_retention_deletes": PATIENT_ROWS,
    "job_clean_since": f"""WITH {CLEAN_PATIENT} SELECT * FROM clean_patient
        WHERE CAST("lastUpdated" AS DATE) >= DATE '2020-02-01'""",
    "job_retention": f"""WITH {RAW_PATIENT}
        SELECT DISTINCT CAST(lastUpdated AS DATE) AS "partitionDate" FROM raw_patient""",
    "job_clean_user": USER_ROWS,
    "job_mart_load": PATIENT_ROWS,
    "job_mart_from_raw": f"""WITH {CLEAN_PATIENT}
        SELECT * FROM clean_patient UNION ALL SELECT * FROM clean_patient""",
    "job_patient_user_mart": JOINED,
    "job_activity_mart": ACTIVITY,
    "job_document_copy": ADDRESS,
    "job_object_store_rows": FLAT_DATED,
    "job_patient_mart_direct": f"""WITH {CLEAN_PATIENT}
        SELECT * EXCLUDE ("partitionDate") FROM clean_patient""",
}
