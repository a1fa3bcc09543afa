from creditloom.sources.landing import audit_landing  # noqa: F401
from creditloom.sources.publish import (  # noqa: F401
    publish,
    publish_if_valid,
    published_runs,
    read_published,
    remove_orphans,
    stage,
)
from creditloom.sources.reports import latest_per_queue, latest_report, write_queues, write_report  # noqa: F401
from creditloom.sources.tables import (  # noqa: F401
    read_csv_table,
    read_dictionary,
    read_parquet_table,
    write_table,
)
