"""Tables in and out: layers, CSV, JDBC, serving layouts, staging."""
