"""Log lines that several tests parse."""

HDFS_LINE = (
    "120703 114259 27 WARN dfs.DataNode$BlockReceiver: Mirror of block blk_-77301 lost "
    "between /172.16.4.9:40110 and /172.16.4.31:50020"
)
STANDARD_LINE = "2025-02-11T06:31:07Z [ERROR] [billing]: worker stopped, no heap space left"
