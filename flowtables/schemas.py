"""Schemas of template documents, rule documents and the flat working tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TEXT = T.StringType()
TEXTS = T.ArrayType(TEXT)
TEXT_MAP = T.MapType(TEXT, TEXT)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# Rule documents -------------------------------------------------------------------------------

RULE = struct(name=TEXT, conditions=TEXTS, actions=TEXT_MAP)
# ``ord`` is written only where an element's place differs from its place in the list: on the
# further pages of a template (see ``sources/exports.py``).
RULE_SET = struct(policy=TEXT, rules=T.ArrayType(T.StructType([*RULE.fields, T.StructField("ord", T.LongType())])))

RULE_XML = struct(
    flowFilePolicy=TEXT,
    rules=T.ArrayType(
        struct(
            id=TEXT,
            name=TEXT,
            conditions=T.ArrayType(struct(id=TEXT, expression=TEXT)),
            actions=T.ArrayType(struct(id=TEXT, attribute=TEXT, value=TEXT)),
        )
    ),
    _corrupt_record=TEXT,
)

# Template documents ---------------------------------------------------------------------------

CONNECTION_SETTINGS = struct(
    name=TEXT,
    zIndex=T.LongType(),
    labelIndex=T.IntegerType(),
    backPressureObjectThreshold=T.LongType(),
    backPressureDataSizeThreshold=TEXT,
    loadBalanceStrategy=TEXT,
    loadBalancePartitionAttribute=TEXT,
    loadBalanceCompression=TEXT,
    flowFileExpiration=TEXT,
    prioritizers=TEXTS,
)

INPUT = T.StructType(
    [
        T.StructField("source", TEXT),
        T.StructField("from", TEXTS),
        T.StructField("to", TEXT),
        T.StructField("position", TEXTS),
        T.StructField("properties", CONNECTION_SETTINGS),
        T.StructField("ord", T.LongType()),
    ]
)

REMOTE_PORT = struct(
    name=TEXT,
    type=TEXT,
    maxConcurrentTasks=T.IntegerType(),
    useCompression=T.BooleanType(),
    batchCount=T.IntegerType(),
    batchSize=TEXT,
    batchDuration=TEXT,
    ord=T.LongType(),
)

COMPONENT = struct(
    name=TEXT,
    type=TEXT,
    id=TEXT,
    template=TEXT,
    position=TEXT,
    comment=TEXT,
    properties=TEXT_MAP,
    styles=TEXT_MAP,
    scheduling=TEXT_MAP,
    inputs=T.ArrayType(INPUT),
    remotePorts=T.ArrayType(REMOTE_PORT),
    advanced=RULE_SET,
    # number of the fragment, for parts of a component without its head
    part=T.LongType(),
    ord=T.LongType(),
)

CONTROLLER = struct(
    name=TEXT,
    type=TEXT,
    id=TEXT,
    comment=TEXT,
    properties=TEXT_MAP,
    part=T.LongType(),
    ord=T.LongType(),
)

TEMPLATE = struct(
    name=TEXT,
    dependencies=T.MapType(TEXT, T.MapType(TEXT, T.MapType(TEXT, TEXT_MAP))),
    controllers=T.ArrayType(CONTROLLER),
    components=T.ArrayType(COMPONENT),
)

# Flat working tables --------------------------------------------------------------------------

TABLES = {
    "templates": struct(workspace=TEXT, template=TEXT),
    "dependencies": struct(
        workspace=TEXT, template=TEXT, grp=TEXT, artifact=TEXT, version=TEXT, name=TEXT, type=TEXT
    ),
    "controllers": struct(
        workspace=TEXT, template=TEXT, id=TEXT, name=TEXT, type=TEXT, comment=TEXT, ord=T.LongType()
    ),
    "components": struct(
        workspace=TEXT,
        template=TEXT,
        id=TEXT,
        name=TEXT,
        type=TEXT,
        kind=TEXT,
        child_template=TEXT,
        x=T.DoubleType(),
        y=T.DoubleType(),
        comment=TEXT,
        policy=TEXT,
        ord=T.LongType(),
    ),
    "properties": struct(
        workspace=TEXT, template=TEXT, owner_id=TEXT, section=TEXT, key=TEXT, value=TEXT
    ),
    "edges": struct(
        workspace=TEXT,
        template=TEXT,
        source_id=TEXT,
        dest_id=TEXT,
        to_port=TEXT,
        relationships=TEXTS,
        bends=TEXTS,
        settings=CONNECTION_SETTINGS,
        ord=T.LongType(),
    ),
    "remote_ports": struct(
        workspace=TEXT,
        template=TEXT,
        component_id=TEXT,
        name=TEXT,
        type=TEXT,
        max_tasks=T.IntegerType(),
        compression=T.BooleanType(),
        batch_count=T.IntegerType(),
        batch_size=TEXT,
        batch_duration=TEXT,
        ord=T.LongType(),
    ),
    "rules": struct(
        workspace=TEXT,
        template=TEXT,
        owner_id=TEXT,
        rule_no=T.LongType(),
        rule_name=TEXT,
        policy=TEXT,
        conditions=TEXTS,
        actions=TEXT_MAP,
    ),
}



def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A table without rows that Catalyst knows to be empty and removes from unions and joins."""
    cells = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields]
    return spark.sql(f"SELECT {', '.join(cells)} WHERE false")


# Reserved component kinds, and the defaults a stored setting is compared with.
RESERVED_KINDS = (
    "INPUT_PORT",
    "OUTPUT_PORT",
    "PROCESS_GROUP",
    "REMOTE_PROCESS_GROUP",
    "FUNNEL",
    "LABEL",
)

SCHEDULING_DEFAULTS = {
    "runSchedule": ["0 sec"],
    "schedulingStrategy": ["TIMER_DRIVEN"],
    "concurrentTasks": ["1"],
    "penaltyDuration": ["30 sec"],
    "yieldDuration": ["1 sec"],
    "runDuration": ["0"],
    "execution": ["ALL"],
    "bulletinLevel": ["WARN"],
}

STYLE_DEFAULTS = {"font-size": ["12px"], "background-color": ["#fff7d7"]}

REMOTE_PORT_DEFAULTS = {"maxConcurrentTasks": ["1"], "useCompression": ["false"]}

REMOTE_DEFAULTS = {"protocol": ["RAW"], "timeout": ["30 sec"], "yieldDuration": ["10 sec"]}

CONNECTION_DEFAULTS = {
    "labelIndex": ["1"],
    "backPressureObjectThreshold": ["10000"],
    "backPressureDataSizeThreshold": ["1 GB"],
    "loadBalanceStrategy": ["DO_NOT_LOAD_BALANCE"],
    "loadBalanceCompression": ["DO_NOT_COMPRESS"],
    "flowFileExpiration": ["0 sec", "0 mins"],
}
