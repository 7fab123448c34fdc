"""Driver tables read as dataset entities, the registered queries and their
DuckDB SQL twins."""
