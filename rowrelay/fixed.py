"""Values that a job must share with the systems around it.

Fixed values: topic names, start-mode numbers, option defaults and timings.
Downstream consumers and existing job files depend on them, so they are kept
together here and are not meant to be tuned.
"""

# Topic names
TOPIC_PREFIX = "mysqlbinlog_"
TOPIC_SEPARATOR = "_"
FALLBACK_TOPIC = "mysqlbinlog_ddl"

# Start modes
START_INITIAL = 0
START_EARLIEST = 1
START_LATEST = 2
START_SPECIFIC = 3
START_TIMESTAMP = 4

# Option defaults
JOB_ID = "mk01"
HOST = "127.0.0.1"
PORT = 3306
USERNAME = "root"
TIMEZONE = "Asia/Shanghai"
KAFKA_BROKERS = "127.0.0.1:9092"
KAFKA_PARTITIONS = 1
PULSAR_SERVICE_URL = "http://127.0.0.1:6650"
PULSAR_ADMIN_URL = "http://127.0.0.1:8080"

# timings
KAFKA_TRANSACTION_TIMEOUT_MS = 600000
TRIGGER_INTERVAL = "3 seconds"
