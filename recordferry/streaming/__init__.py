"""Reserved package.

The migration has no streams, watermarks or state: an incremental run is a
batch anti-join against the export log or a result table, run again
(`operators.match.not_logged`, `operators.images.copy_plan`,
`operators.images.requeue`).
"""
