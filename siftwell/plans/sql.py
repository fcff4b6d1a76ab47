"""SQL fragments shared by the reference queries."""


def uuid_sql(c: str) -> str:
    """Canonical UUID of a spelling, as in functions.ids.canonical_uuid."""
    bare = f"regexp_replace(regexp_replace(lower(trim({c})), '^urn:uuid:', ''), '[{{}}-]', '', 'g')"
    dashed = lambda h: f"concat_ws('-', {h}[1:8], {h}[9:12], {h}[13:16], {h}[17:20], {h}[21:32])"
    number = f"lpad(lower(to_hex(try_cast(trim({c}) AS UHUGEINT))), 32, '0')"
    return (
        f"CASE WHEN regexp_full_match({bare}, '[0-9a-f]{{32}}') THEN {dashed(f'({bare})')} "
        f"WHEN regexp_full_match(trim({c}), '[0-9]{{1,39}}') THEN {dashed(f'({number})')} "
        f"WHEN trim({c}) <> '' THEN lower(trim({c})) END"
    )


def path_sql(c: str) -> str:
    """Plain object path, as in functions.paths.plain_path."""
    decoded = f"CASE WHEN contains({c}, '%') THEN url_decode({c}) ELSE {c} END"
    slashed = f"replace({decoded}, '\\', '/')"
    inner = f"regexp_replace({slashed}, '^[sS]3:/+[^/]*/', '')"
    return f"regexp_replace(regexp_replace({inner}, '/{{2,}}', '/', 'g'), '^(?:\\./|/)+', '')"


def tag_sql(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '[\\s_\\-]+', ' ', 'g'))"


def etag_sql(c: str) -> str:
    return f"lower(replace(regexp_replace(trim({c}), '^[wW]/', ''), '\"', ''))"


PRESENT_OBJECTS = f"""
present AS (
  SELECT taken_at, path, arg_max(st, (coalesce(epoch_us(st.last_modified), -9e18), coalesce(st.content_length, -1), coalesce(st.etag, ''))) AS st
  FROM (SELECT taken_at, {path_sql('path')} AS path,
               struct_pack(last_modified := last_modified, content_length := content_length, etag := {etag_sql('etag')}) AS st
        FROM object_listing WHERE mode = 'FILE' AND NOT coalesce(is_deleted, FALSE) AND path IS NOT NULL)
  GROUP BY ALL),
snaps AS (SELECT taken_at, max(snapshot_no) AS snapshot_no, row_number() OVER (ORDER BY taken_at) AS seq
          FROM object_listing GROUP BY taken_at)
"""
