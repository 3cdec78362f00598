import pytest

from rowrelay import Options

JOB_FILE = {
    "job": {"id": "orders", "checkpoint-directory": "hdfs://c/checkpoint"},
    "datasource": {
        "mysql": {
            "host": "db1",
            "port": 3307,
            "username": "reader",
            "password": 123456,
            "slave_id": 1000,
            "timezone": "Asia/Shanghai",
            "databases": "test",
            "tables": "test.tb_order",
            "startup_mode": 4,
            "startup_timestamp": 1694186699000,
        }
    },
    "sink": {"kafka": {"brokers": "k1:9092", "parallelism": 2, "partition": 3}},
}


def test_job_file():
    opts = Options.from_mapping(JOB_FILE, zone="UTC")
    assert (opts.job_id, opts.checkpoint_dir, opts.zone) == ("orders", "hdfs://c/checkpoint", "UTC")
    assert (opts.host, opts.port, opts.username, opts.password) == ("db1", 3307, "reader", "123456")
    assert (opts.databases, opts.tables) == ("test", "test.tb_order")
    assert (opts.start_mode, opts.start_timestamp) == (4, 1694186699000)
    assert (opts.brokers, opts.partitions, opts.sink_parallelism) == ("k1:9092", 3, 2)


def test_defaults():
    opts = Options.from_mapping({"job": None})
    assert (opts.job_id, opts.host, opts.port, opts.username, opts.password) == ("mk01", "127.0.0.1", 3306, "root", None)
    assert (opts.timezone, opts.start_mode, opts.start_timestamp) == ("Asia/Shanghai", 0, 0)
    assert (opts.brokers, opts.partitions) == ("127.0.0.1:9092", 1)
    assert (opts.service_url, opts.admin_url) == ("http://127.0.0.1:6650", "http://127.0.0.1:8080")
    pulsar = {"sink": {"pulsar": {"service-url": "pulsar://a:1", "admin-url": "http://a:2"}}}
    opts = Options.from_mapping(pulsar)
    assert (opts.service_url, opts.admin_url) == ("pulsar://a:1", "http://a:2")


@pytest.mark.parametrize(
    "wrong",
    [
        {"partitions": 0},
        {"partitions": -1},
        {"partitions": "4"},
        {"partitions": True},
        {"partitions": {"t": 0}},
        {"default_partitions": 0},
        {"sink_parallelism": 0},
        {"start_mode": 4},
        {"order": "global"},
        {"delete_partition": "any"},
    ],
)
def test_wrong_options(wrong):
    with pytest.raises(ValueError):
        Options(**wrong)


@pytest.mark.parametrize("name", ["start_mode", "start_timestamp", "port"])
@pytest.mark.parametrize("value", ["4", 4.0, True, None])
def test_numbers_must_be_numbers(name, value):
    with pytest.raises(ValueError, match=name):
        Options(**{name: value})


def test_parallelism_of_one_warns():
    with pytest.warns(UserWarning, match="order"):
        Options.from_mapping({"sink": {"kafka": {"parallelism": 1}}})
