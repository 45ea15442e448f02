import pytest

from sievework.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[4]", spark_ui_enabled="false", spark_sql_shuffle_partitions="4", spark_driver_memory="3g", spark_ui_showConsoleProgress="false")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
