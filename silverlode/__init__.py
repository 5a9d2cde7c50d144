"""silverlode: PySpark operators that turn raw trip files into trusted lake layers."""
