"""Fixed schemas of the tables the jobs read and write (no inference)."""
UPLOAD_LOG = (
    "LOCAL_FOLDER string, LOCAL_PATH string, FILE_SIZE long, BUCKET_NAME string, DESTINATION_KEY string, "
    "CHECKSUM string, ZIP_CONTENTS string, FILES_PER_ZIP string, UPLOAD_TIME double, "
    "UPLOAD_START string, UPLOAD_END string"
)
EXTRACT_PLAN = "key string, extract boolean"
RUN_LOG = "file string, line_no long, value string"
