"""Outcome statuses and the one exception type of the library."""

from __future__ import annotations

import json

# --- fixed values: status names of the reference's error payload --------------------------
MISSING_FILE = "missing_file"
EMPTY_DATA = "empty_data"
MISSING_PARAMETERS = "missing_parameters"
DATABASE_ERROR = "database_error"
AUDIT_DELETE_ERROR = "audit_delete_error"
AUDIT_WRITE_ERROR = "audit_write_error"
PIPELINE_FAILURE = "pipeline_failure"
CASCADING_FAILURE = "cascading_failure"
ORCHESTRATION_CHILD_FAILURE = "orchestration_child_failure"
PROCESSED = "processed"
# ----------------------------------------------------------------------------------------


class IntakeError(Exception):
    """A failed unit of work with a machine-readable status, path and reason."""

    def __init__(self, status: str, reason: str, path: str = "Unknown"):
        self.status = status
        self.reason = reason
        self.path = path
        super().__init__(self.payload())

    def payload(self) -> str:
        return json.dumps({"status": self.status, "failed_file_path": self.path,
                           "reason": self.reason})
