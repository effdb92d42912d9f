"""Sources and sinks: table scans, slices and writers (``tables``), JSON
directories and manifests (``files``), the result sink (``sinks``) and the
fault-injecting generator (``synth``)."""
