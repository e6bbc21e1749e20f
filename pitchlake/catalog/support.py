"""Tables the engine keeps for itself: the run log, the data dictionary, damaged documents and landed files."""

from __future__ import annotations

from pitchlake.catalog.columns import Column, TableLayout

RUNS = TableLayout(
    columns=(
        Column("chunk_start", "date", ("temporal",), "First day of the chunk.", required=True),
        Column("chunk_end", "date", ("temporal",), "Last day of the chunk.", required=True),
        Column("chunk_kind", "string", ("category",), "How the range was cut.", required=True,
               allowed=("year", "month", "range")),
        Column("rows_written", "bigint", ("count",), "Pitches written."),
        Column("status", "string", ("category",), "How the attempt ended.", required=True,
               allowed=("success", "empty", "failed")),
        Column("started_at", "timestamp", ("temporal",), "Start of the attempt.", required=True),
        Column("finished_at", "timestamp", ("temporal",), "End of the attempt."),
        Column("library_version", "string", ("version",), "Version that ran."),
        Column("error", "string", ("message",), "Why the attempt failed."),
    ),
    comment="One row per load attempt of a chunk of days.",
)

DICTIONARY = TableLayout(
    columns=(
        Column("dataset", "string", ("identifier",), "Database of the table.", required=True),
        Column("table", "string", ("identifier",), "Table.", required=True),
        Column("column", "string", ("identifier",), "Column.", required=True),
        Column("dtype", "string", ("type",), "Spark type."),
        Column("description", "string", ("text",), "What the column holds."),
        Column("business_definition", "string", ("text",), "Description plus its rules."),
        Column("owner", "string", ("text",), "Who answers for the column."),
        Column("tags", "array<string>", ("category",), "Column groups."),
        Column("source_system", "string", ("text",), "Where the values come from."),
        Column("upstream_lineage_json", "string", ("text",), "Library, version and feed field."),
        Column("created_at", "timestamp", ("temporal",), "When the row was made."),
        Column("updated_at", "timestamp", ("temporal",), "When the row was last changed."),
    ),
    comment="One row per documented column.",
    partition_by=("dataset", "table"),
    key=("dataset", "table", "column"),
)

QUARANTINE = TableLayout(
    columns=(
        Column("kind", "string", ("category",), "What the document was landed as.", required=True,
               allowed=("schedule", "boxscore", "standings")),
        Column("reason", "string", ("category",), "What is wrong with it.", required=True,
               allowed=("unreadable", "no answer")),
        Column("season", "bigint", ("temporal",), "Season of the landing folder."),
        Column("game_pk", "bigint", ("identifier",), "Game of the landing folder."),
        Column("version", "bigint", ("version",), "Version of the document."),
        Column("file", "string", ("text",), "File it was read from."),
        Column("document", "string", ("text",), "The text, where it could not be read."),
        Column("seen_at", "timestamp", ("temporal",), "When it was put aside.", required=True),
    ),
    comment="Landed documents that were not used, one row each time a load met one.",
)

FILES = TableLayout(
    columns=(
        Column("path", "string", ("identifier",), "Path of the file.", required=True),
        Column("modified", "bigint", ("version",), "When it was written, in microseconds.", required=True),
        Column("bytes", "bigint", ("count",), "Size of the file.", required=True),
        Column("rows", "bigint", ("count",), "Rows in the file.", required=True),
        Column("first_day", "date", ("temporal",), "Smallest day in the file."),
        Column("last_day", "date", ("temporal",), "Largest day in the file."),
        Column("schema", "string", ("type",), "Columns of the files it landed with, as JSON.", required=True),
        Column("noted_at", "timestamp", ("temporal",), "When the row was made.", required=True),
    ),
    comment="One row per landed file and state of it.",
    key=("path", "modified"),
)
